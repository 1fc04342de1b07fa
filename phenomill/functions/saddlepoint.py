"""Saddlepoint tail probabilities of many score statistics at once, over arrays of their carriers.

A carrier adds log(1 - mu + mu e^(gt)) - mu g t to the cumulant function, all others together a normal part with variance
``rest``. Carriers of all problems are in flat arrays; ``row`` tells whose they are.
"""

from __future__ import annotations

import math

import numpy as np

FAR = 1e6


def cumulants(g: np.ndarray, mu: np.ndarray, row: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The carriers' part of the cumulant function and its first two derivatives at ``t`` for each problem."""
    gt, n = g * t[row], len(t)
    # mu e^(gt) / (1 - mu + mu e^(gt)) and log(1 - mu + mu e^(gt)) without overflow
    tilt = 1.0 / (1.0 + (1.0 - mu) / mu * np.exp(-np.clip(gt, -500.0, 500.0)))
    log_mgf = np.where(gt > 0, gt + np.log((1.0 - mu) * np.exp(-np.abs(gt)) + mu), np.log1p(mu * np.expm1(np.minimum(gt, 0.0))))
    parts = (log_mgf - mu * gt, g * (tilt - mu), g * g * tilt * (1.0 - tilt))
    return tuple(np.bincount(row, p, n) for p in parts)


def reached(q: np.ndarray, rest: np.ndarray, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """Whether there is a root: the slope of the carriers' part tends to ``top`` and ``bottom`` far out."""
    return (rest > 0) | (q < top) & (q > bottom)


def start(q: np.ndarray, var: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """t, low, high: the first step of Newton from 0, and brackets between 0 and the far side."""
    return q / var, np.where(q > 0, 0.0, -FAR), np.where(q > 0, FAR, 0.0)


def step(number: int, t, low, high, q, rest, k1, k2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """t, low, high, done after the ``number``-th look; t stays where it is done.

    Newton inside the bracket; every third time its middle, by factors while it spans more than one of four.
    """
    excess = k1 + rest * t - q
    low, high = np.where(excess < 0, t, low), np.where(excess > 0, t, high)
    newton = t - excess / np.maximum(k2 + rest, 1e-300)
    near, far = np.minimum(np.abs(low), np.abs(high)), np.maximum(np.abs(low), np.abs(high))
    middle = np.where(far > 4 * near, np.sign(q) * np.sqrt(np.maximum(near, 1e-9) * far), (low + high) / 2)
    following = np.where((newton > low) & (newton < high) & (number % 3 != 0), newton, middle)
    found = np.abs(excess) <= 1e-7 * np.maximum(np.abs(q), 1.0)
    done = found | (high - low <= 1e-12 * np.maximum(np.abs(t), 1e-6)) | (following == t)
    return np.where(done, t, following), low, high, done


def tails(t, q, rest, var, k0, k1, k2) -> np.ndarray:
    """Probability beyond q on its side, by Lugannani and Rice; NaN where t is no root."""
    with np.errstate(all="ignore"):
        slope, curve = k1 + rest * t, k2 + rest
        square = 2 * (t * q - k0 - rest * t * t / 2)
        sound = (np.abs(slope - q) <= 1e-4 * np.maximum(1.0, np.abs(q))) & (square > 0) & (curve > 0)
        w = np.copysign(np.sqrt(square), t)
        v = t * np.sqrt(curve)
        z = (w + np.log(v / w) / w) * np.sign(q) / math.sqrt(2)
        z = np.where((np.abs(w) < 1e-4) | (v / w <= 0), np.abs(q) / np.sqrt(2 * var), z)
    erfc = np.frompyfunc(math.erfc, 1, 1)
    return np.where(sound, 0.5 * erfc(np.where(sound, z, 0.0)).astype(float), np.nan)


def solve(g, mu, row, q, var, rest, possible) -> np.ndarray:
    """Tail probabilities of all problems; those that aren't ``possible`` have none."""
    t, low, high = start(q, var)
    k = np.full((3, len(q)), np.nan)
    open_, number = np.flatnonzero(possible), 0
    while len(open_):
        number += 1
        place = np.full(len(q), -1)
        place[open_] = np.arange(len(open_))
        own = place[row]
        g, mu, row, own = (x[own >= 0] for x in (g, mu, row, own))
        k[:, open_] = cumulants(g, mu, own, t[open_])
        t[open_], low[open_], high[open_], done = step(
            number, t[open_], low[open_], high[open_], q[open_], rest[open_], k[1, open_], k[2, open_]
        )
        open_ = open_[~done]
    return tails(t, q, rest, var, *k)
