"""Small numeric helpers used on result-sized rows (Arrow batches, never raw data)."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    fraction = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            fraction *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * fraction / a


def pearson_p(r: float, n: float) -> float:
    """Two-sided p-value of a Pearson correlation of n pairs."""
    if r is None or n is None or math.isnan(r) or n < 3:
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    return incomplete_beta((n - 2) / 2.0, 0.5, 1.0 - r * r)


def hwe_exact(hom_ref: int, het: int, hom_alt: int) -> float:
    """Exact Hardy-Weinberg p-value of three genotype counts."""
    n = hom_ref + het + hom_alt
    if n == 0:
        return 1.0
    rare = 2 * min(hom_ref, hom_alt) + het
    hets = np.arange(rare % 2, rare + 1, 2, dtype=float)
    if hets.size == 1:
        return 1.0
    # log P(h + 2) - log P(h) for consecutive heterozygote counts h
    h = hets[:-1]
    rare_hom = (rare - h) / 2.0
    common_hom = n - h - rare_hom
    steps = np.log(4.0 * rare_hom * common_hom) - np.log((h + 2.0) * (h + 1.0))
    log_p = np.concatenate([[0.0], np.cumsum(steps)])
    log_p -= log_p.max()
    weights = np.exp(log_p)
    seen = log_p[int((het - rare % 2) // 2)]
    return float(min(1.0, weights[log_p <= seen + 1e-9].sum() / weights.sum()))


@F.pandas_udf(DoubleType())
def hwe_exact_p(hom_ref: pd.Series, het: pd.Series, hom_alt: pd.Series) -> pd.Series:
    return pd.Series([hwe_exact(int(a), int(b), int(c)) for a, b, c in zip(hom_ref, het, hom_alt)])


@F.pandas_udf(DoubleType())
def normal_quantile(p: pd.Series) -> pd.Series:
    inverse = NormalDist().inv_cdf
    return p.map(lambda x: inverse(x) if 0.0 < x < 1.0 else None)


@F.pandas_udf(DoubleType())
def chi2_1_tail(x: pd.Series) -> pd.Series:
    """Upper tail of chi-square with one degree of freedom."""
    return x.map(lambda v: math.erfc(math.sqrt(v / 2.0)) if v >= 0 else None)


@F.pandas_udf(DoubleType())
def pearson_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([pearson_p(a, b) for a, b in zip(r, n)])
