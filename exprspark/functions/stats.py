"""Distribution functions that Spark lacks, as vectorized UDFs over numpy.

They run on result rows (one per test), never on data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _lgamma(x) -> np.ndarray:
    return np.array([math.lgamma(v) for v in np.ravel(x)]).reshape(np.shape(x))


def _erfc(x) -> np.ndarray:
    return np.array([math.erfc(v) for v in np.ravel(x)]).reshape(np.shape(x))


def log_choose(n, k):
    return _lgamma(n + 1.0) - _lgamma(k + 1.0) - _lgamma(n - k + 1.0)


def normal_two_sided_p(z):
    return _erfc(np.abs(np.asarray(z, dtype=float)) / math.sqrt(2))


def hypergeom_log_upper(k, m, n, total):
    """log P(overlap >= k) for a set of m and a query of n out of total, by the term ratio."""
    k, m, n, total = (np.asarray(x, dtype=float) for x in (k, m, n, total))
    top = np.minimum(m, n)
    i = k.copy()
    term = np.ones_like(i)
    acc = np.ones_like(i)
    live = i < top
    while live.any():
        ratio = (m - i) * (n - i) / ((i + 1) * (total - m - n + i + 1))
        term = np.where(live, term * ratio, term)
        acc = np.where(live, acc + term, acc)
        i = i + live
        live = live & (i < top) & (term > acc * 1e-18)
    first = log_choose(m, k) + log_choose(total - m, n - k) - log_choose(total, n)
    return np.minimum(0.0, first + np.log(acc))


def hypergeom_upper(k, m, n, total):
    return np.exp(hypergeom_log_upper(k, m, n, total))


def chi2_upper(x, df):
    """Upper tail for one or two degrees of freedom."""
    x = np.maximum(np.asarray(x, dtype=float), 0)
    return np.where(np.asarray(df) == 2, np.exp(-x / 2), _erfc(np.sqrt(x / 2)))


def poisson_upper(k, mu):
    """P(X >= k): a lower-tail sum below the mean, an upper-tail series above it."""
    k, mu = np.asarray(k, dtype=float), np.asarray(mu, dtype=float)
    safe = np.maximum(mu, 1e-300)
    logp = k * np.log(safe) - safe - _lgamma(k + 1.0)
    upper = k > mu
    term, acc, i = np.ones_like(k), np.ones_like(k), k.copy()
    while True:  # the ratio of terms falls below one and goes on falling
        i = i + 1
        term = term * np.where(upper, safe / i, 0.0)
        acc = acc + term
        if not (term > acc * 1e-17).any():
            break
    tail = np.exp(logp) * acc
    term, acc, i = np.ones_like(k), np.zeros_like(k), k.copy()
    while True:
        term = term * np.where(upper, 0.0, np.maximum(i, 0) / safe)
        acc = acc + term
        i = i - 1
        if not (term > np.maximum(acc, 1e-300) * 1e-17).any():
            break
    below = 1 - np.exp(logp) * acc
    out = np.where(upper, tail, below)
    return np.clip(np.where(k <= 0, 1.0, np.where(mu <= 0, 0.0, out)), 0.0, 1.0)


def _betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _betainc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, 1000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / (d if abs(d) > 1e-300 else 1e-300)
            c = c if abs(c) > 1e-300 else 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def t_quantile(p: float, df: float) -> float:
    """Student t quantile by bisection on the tail probability."""
    if df is None or not df >= 1:
        return math.nan
    tail = 1 - p if p > 0.5 else p
    lo, hi = 0.0, 1.0

    def upper(t):
        return 0.5 * _betainc(df / 2, 0.5, df / (df + t * t))

    while upper(hi) > tail:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if upper(mid) > tail else (lo, mid)
        if hi - lo <= 1e-14 * hi:
            break
    return (lo + hi) / 2 * (1 if p > 0.5 else -1)


def hypergeom_sf(k: Column, m: Column, n: Column, total: Column) -> Column:
    @F.pandas_udf("double")
    def f(k: pd.Series, m: pd.Series, n: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series(hypergeom_upper(k, m, n, total))

    return f(k, m, n, total)


def hypergeom_log_sf(k: Column, m: Column, n: Column, total: Column) -> Column:
    @F.pandas_udf("double")
    def f(k: pd.Series, m: pd.Series, n: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series(hypergeom_log_upper(k, m, n, total))

    return f(k, m, n, total)


def chi2_sf(x: Column, df: Column | int = 1) -> Column:
    @F.pandas_udf("double")
    def f(x: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(chi2_upper(x, df)).where(x.notna())

    return f(x, F.lit(df) if isinstance(df, int) else df)


def normal_two_sided(z: Column) -> Column:
    @F.pandas_udf("double")
    def f(z: pd.Series) -> pd.Series:
        return pd.Series(normal_two_sided_p(z))

    return f(z)


def poisson_sf(k: Column, mu: Column) -> Column:
    @F.pandas_udf("double")
    def f(k: pd.Series, mu: pd.Series) -> pd.Series:
        return pd.Series(poisson_upper(k, mu))

    return f(k, mu)


def t_quantile_col(p: float, df: Column) -> Column:
    @F.pandas_udf("double")
    def f(df: pd.Series) -> pd.Series:
        return df.map({v: t_quantile(p, v) for v in df.dropna().unique()}).astype(float)

    return f(df)
