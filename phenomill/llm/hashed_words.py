"""Words of many texts at once as 64-bit hashes, straight from Arrow's buffers.

Texts are taken in chunks of about ``CHUNK`` bytes, or of as many as asked for; a longer text is a chunk of its own. A chunk beyond
``CHUNK`` is read in segments cut between words, so that only its words' offsets and hashes (24 bytes a word) are held whole. The hash of a word is the difference of two prefix
sums of a polynomial over its bytes, brought to the same power; it equals ``common.word_hashes``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from phenomill.llm.common import _MIX_B, _PRIME, mix, powers

CHUNK = 1 << 20
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_inverses = np.ones(1, dtype=np.uint64)

UPPER = np.arange(256, dtype=np.uint8)
UPPER[ord("A") : ord("Z") + 1] += 32


def separators(chars: str) -> np.ndarray:
    """256 booleans for ASCII characters."""
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


WHITE = separators(" \t\n\v\f\r")


class Chunk(NamedTuple):
    """Texts ``first`` to ``last`` of a batch: bytes of the whole chunk, and the words with their text's number from 0."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray


def _inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        grown = np.full(max(n, 2 * len(_inverses)), _INVERSE, dtype=np.uint64)
        grown[0] = 1
        _inverses = np.multiply.accumulate(grown)
    return _inverses[:n]


def _segment(data: np.ndarray, cuts: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in ``data``; words also end at ``cuts``."""
    inside = ~breaks[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begin[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _inverse_powers(len(data))[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64) * _MIX_B)


def _long(data: np.ndarray, cuts: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A long chunk in segments that end at a separator; words also end at ``cuts``, which ascend."""
    parts, at = [], 0
    while at < len(data):
        to = min(at + CHUNK, len(data))
        while to < len(data) and not breaks[data[to]]:
            ahead = np.flatnonzero(breaks[data[to : to + 65536]])
            to = to + int(ahead[0]) if len(ahead) else min(to + 65536, len(data))
        own = cuts[np.searchsorted(cuts, at) : np.searchsorted(cuts, to)]
        starts, ends, hashes = _segment(data[at:to], own - at, breaks)
        parts.append((starts + at, ends + at, hashes))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts))


def chunks(column: pa.Array, breaks: np.ndarray = WHITE, lower: bool = True, size: int | None = None) -> Iterator[Chunk]:
    """The texts of a string column, null as empty, in chunks of ``size`` bytes; ``lower`` lower-cases A to Z."""
    size = size or CHUNK
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        part = data[offsets[first] : offsets[last]]
        if lower:
            part = UPPER[part]
        local = offsets[first:last] - offsets[first]
        if len(part) > CHUNK:
            starts, ends, hashes = _long(part, local, breaks)
        else:
            starts, ends, hashes = _segment(part, local, breaks)
        owner = np.searchsorted(local, starts, side="right") - 1
        yield Chunk(first, last, part, starts, ends, owner, hashes)
        first = last
