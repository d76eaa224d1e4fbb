"""Two-group differential expression: a negative-binomial GLM per feature, and cells summed to samples for it.

Spark gathers each feature's counts; a task fits some features at a time as numpy expressions over the counts that
are there. What the absent pairs add depends on the rate and dispersion alone and is read from a table. Only per-sample
constants, these tables and a handful of grid sums are held outside of the tasks.

The dispersion estimator is defined here and makes no claim of equality with any other package:
a common dispersion maximizes the adjusted profile likelihood summed over all features on a
log-spaced grid, and each feature maximizes its own curve plus ``prior_n`` times the mean curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.functions.stats import chi2_sf
from exprspark.operators.hurdle import hurdle_de  # noqa: F401  (the cell-level test next to the sample-level one)
from exprspark.operators.normalize import effective_library
from exprspark.operators.ranking import bh_adjust
from exprspark.session import spread, stage

GRID = np.exp(np.linspace(math.log(1e-4), math.log(10.0), 21))
BLOCK_COUNTS = 1_000_000  # counts that a task fits at a time
KNOT = 0.02  # distance of the knots of :class:`_Sums`
MAX_SAMPLES = 1_000_000


def design(samples: DataFrame, ref: str, trt: str) -> DataFrame:
    """Treatment coding of two groups against an explicit reference level."""
    s = samples.filter(F.col("group").isin(ref, trt))
    return s.withColumn("intercept", F.lit(1.0)).withColumn("trt", F.when(F.col("group") == trt, 1.0).otherwise(0.0))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of positive numbers: shift to 8 and above, then Stirling's series."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        if not low.any():
            break
        shift = np.where(low, shift + np.log(y), shift)
        y = np.where(low, y + 1, y)
    z = 1 / (y * y)
    tail = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - shift


class _Sums:
    """``sum(log1p(exp(t) * lib))`` over all libraries and its derivative, for any ``t``.

    They are smooth functions of one number, so values at knots are interpolated by fifth-degree polynomials that also fit the
    first two derivatives: to double precision, for as many libraries as there are. Far out they are straight lines.
    """

    def __init__(self, lib: np.ndarray):
        lib = lib[lib != 0]
        known = lib[lib > 0] if (lib > 0).any() else np.ones(1)
        self.n, self.total, self.logs = len(lib), lib.sum(), np.log(lib).sum()
        self.low, self.high = -math.log(known.max()) - 37, -math.log(known.min()) + 37
        knots = self.low + KNOT * np.arange(math.ceil((self.high - self.low) / KNOT) + 1)
        self.at_knots = np.empty((4, len(knots)))
        step = max(1, 4_000_000 // max(len(lib), 1))
        for i in range(0, len(knots), step):
            z = np.exp(knots[i:i + step, None]) * lib
            s = z / (1 + z)
            d = s / (1 + z)
            self.at_knots[:, i:i + step] = np.log1p(z).sum(axis=1), s.sum(axis=1), d.sum(axis=1), (d * (1 - z) / (1 + z)).sum(axis=1)

    def _between(self, i: np.ndarray, u: np.ndarray, row: int) -> np.ndarray:
        f, d, c = self.at_knots[row], self.at_knots[row + 1] * KNOT, self.at_knots[row + 2] * KNOT * KNOT / 2
        a0, a1, a2, rise = f[i], d[i], c[i], f[i + 1] - f[i]
        p, q, r = rise - a1 - a2, d[i + 1] - a1 - 2 * a2, c[i + 1] - a2
        return a0 + u * (a1 + u * (a2 + u * (10 * p - 4 * q + r + u * (7 * q - 15 * p - 2 * r + u * (6 * p - 3 * q + r)))))

    def at(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = (np.clip(t, self.low, self.high) - self.low) / KNOT
        i = np.clip(np.nan_to_num(place).astype(int), 0, self.at_knots.shape[1] - 2)
        flat = np.exp(np.minimum(t, self.low)) * self.total
        value = np.where(t < self.low, flat, np.where(t > self.high, self.n * t + self.logs, self._between(i, place - i, 0)))
        slope = np.where(t < self.low, flat, np.where(t > self.high, float(self.n), self._between(i, place - i, 1)))
        return value, slope


class _Counts:
    """The present counts of some features in some libraries: feature (its place), count and library size."""

    def __init__(self, n: int, row: np.ndarray, y: np.ndarray, lib: np.ndarray):
        self.n, self.row, self.y, self.lib = n, row, y, lib
        self.total = self.by_feature(y)

    def by_feature(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, values, self.n)

    def some(self, chosen: np.ndarray) -> _Counts:
        """The same for the chosen features."""
        to, inside = np.cumsum(chosen) - 1, chosen[self.row]
        return _Counts(int(chosen.sum()), to[self.row[inside]], self.y[inside], self.lib[inside])


def _fit_rate(c: _Counts, sums: _Sums, phi: np.ndarray, start: np.ndarray | None = None):
    """Log rate per feature of ``y ~ NB(lib * rate, phi)`` by Fisher scoring, the log likelihood, and the sum of the weights.

    The likelihood leaves out the terms that do not depend on the rate. All-zero rows have rate 0.
    """
    some = c.total > 0
    beta = np.log(np.where(some, c.total, 1.0) / sums.total) if start is None else start
    beta = np.where(some, beta, -700.0)
    log_phi = np.log(phi)
    open_, part = np.flatnonzero(some), c.some(some)
    for _ in range(50):
        if not len(open_):
            break
        t = beta[open_] + log_phi[open_]
        weight = sums.at(t)[1] / phi[open_]
        step = (part.by_feature(part.y / (1 + np.exp(t)[part.row] * part.lib)) - weight) / np.maximum(weight, 1e-300)
        beta[open_] += np.clip(step, -3, 3)
        more = ~(np.abs(step) < 1e-9)
        if 2 * more.sum() <= len(open_):  # settled features leave, half of them at a time
            open_, part = open_[more], part.some(more)
    t = beta + log_phi
    value, slope = sums.at(t)
    present = c.by_feature(c.y * (np.log(c.lib) - np.log1p(np.exp(t)[c.row] * c.lib)))
    return beta, c.total * np.where(some, beta, 0.0) + present - value / phi, slope / phi


def _profiles(groups: Sequence[_Counts], sums: Sequence[_Sums]) -> np.ndarray:
    """Adjusted profile likelihood over the dispersion grid, one row per feature.

    The gamma terms of a zero count vanish and equal counts share theirs; each grid point starts
    from the rate of the one before.
    """
    values, inverse = np.unique(np.concatenate([c.y for c in groups]), return_inverse=True)
    row = np.concatenate([c.row for c in groups])
    n, total = groups[0].n, groups[0].total + groups[1].total
    out = np.empty((n, len(GRID)))
    start: list = [None, None]
    for j, phi in enumerate(GRID):
        gamma = np.where(values > 0, _lgamma(values + 1 / phi) - _lgamma(np.array(1 / phi)), 0.0)
        apl = np.bincount(row, gamma[inverse.ravel()], n) + math.log(phi) * total
        for k in (0, 1):
            start[k], ll, weight = _fit_rate(groups[k], sums[k], np.full(n, phi), start[k])
            apl += ll - 0.5 * np.log(np.maximum(weight, 1e-10))
        out[:, j] = apl
    return out


def _peak(curves: np.ndarray) -> np.ndarray:
    """Dispersion at the maximum of each curve over the log grid, refined by a parabola."""
    lg = np.log(GRID)
    i = np.clip(curves.argmax(axis=1), 1, len(GRID) - 2)
    rows = np.arange(len(curves))
    a, b, c = curves[rows, i - 1], curves[rows, i], curves[rows, i + 1]
    den = a - 2 * b + c
    shift = np.where(den < 0, 0.5 * (a - c) / np.where(den < 0, den, -1.0), 0.0)
    edge = (curves.argmax(axis=1) == 0) | (curves.argmax(axis=1) == len(GRID) - 1)
    at = np.where(edge, lg[curves.argmax(axis=1)], lg[i] + np.clip(shift, -1, 1) * (lg[1] - lg[0]))
    return np.exp(at)


def differential_expression(
    matrix: DataFrame, lib: DataFrame, samples: DataFrame, ref: str, trt: str,
    prior_df: float = 10.0, dispersion: float | None = None,
) -> DataFrame:
    """Likelihood-ratio test of one group against the other for every feature.

    ``lib`` is ``sample_id, lib_size[, norm_factor]``. Returns ``feature_id, log_fc, log_cpm, lr,
    p_value, fdr, dispersion``. A group without any count is given 0.125 reads for ``log_fc``.
    """
    s = design(samples, ref, trt).join(lib, "sample_id").select("sample_id", "trt", effective_library(lib).alias("eff"))
    info = s.orderBy("sample_id").limit(MAX_SAMPLES + 1).toPandas()  # three values per library
    if len(info) > MAX_SAMPLES:
        raise ValueError("more libraries than a per-feature fit is meant for; sum cells to samples first")
    sizes, group = info["eff"].to_numpy(float), info["trt"].to_numpy(float)
    n = len(info)
    index = matrix.sparkSession.createDataFrame(
        pd.DataFrame({"sample_id": info["sample_id"], "idx": np.arange(n)}), "sample_id string, idx int")
    # a feature is one array of at most n entries; a task fits a few features at a time
    rows = matrix.join(F.broadcast(index), "sample_id").groupBy("feature_id").agg(F.collect_list(F.struct("idx", "count")).alias("c"))
    rows = rows.select("feature_id", F.col("c.idx").alias("idx"), F.col("c.count").cast("array<double>").alias("cnt"))
    rows = spread(rows, "feature_id")
    sums = [_Sums(sizes[group == g]) for g in (0, 1)]
    all_sums = _Sums(sizes)

    def counts(pdf: pd.DataFrame) -> list[_Counts]:
        """The counts of both groups, and of all libraries."""
        row = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["idx"]])
        idx, y = np.concatenate(pdf["idx"].to_list()), np.concatenate(pdf["cnt"].to_list()).astype(float)
        return [_Counts(len(pdf), row[at], y[at], sizes[idx[at]]) for at in (group[idx] == 0, group[idx] == 1, np.full(len(idx), True))]

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                for _, part in pdf.groupby(np.cumsum([len(x) for x in pdf["idx"]]) // BLOCK_COUNTS):
                    yield part

    mean_curve = None
    if dispersion is None:
        def curves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts(batches):
                yield pdf.assign(curve=list(_profiles(counts(pdf)[:2], sums)))

        # the one table that is written: its mean curve is needed before any fit
        rows = stage(rows.mapInPandas(curves, "feature_id string, idx array<int>, cnt array<double>, curve array<double>"))
        mean_curve = np.array(rows.agg(*[F.avg(F.col("curve")[i]) for i in range(len(GRID))]).first(), dtype=float)
    prior_n = prior_df / max(n - 2, 1)

    def fit_part(pdf: pd.DataFrame) -> pd.DataFrame:
        *parts_of, every = counts(pdf)
        if dispersion is not None:
            phi = np.full(len(pdf), float(dispersion))
        else:
            phi = _peak(np.stack(pdf["curve"].to_numpy()) + prior_n * mean_curve)
        b, full = [], 0.0
        for g in (0, 1):
            beta, ll, _ = _fit_rate(parts_of[g], sums[g], phi)
            b.append(beta)
            full = full + ll
        _, null, _ = _fit_rate(every, all_sums, phi)
        low = [math.log(0.125 / sizes[group == g].sum()) for g in (0, 1)]
        fc = (np.maximum(b[1], low[1]) - np.maximum(b[0], low[0])) / math.log(2)
        share = 2 / sizes.mean()  # the prior count grows with the library, so an absent pair has the same value in all
        log_cpm = np.log2((share / (1 + 2 * share) + every.by_feature(every.y / (every.lib * (1 + 2 * share))) / n) * 1e6)
        return pd.DataFrame({
            "feature_id": pdf["feature_id"], "log_fc": fc, "log_cpm": log_cpm,
            "lr": np.maximum(2 * (full - null), 0.0), "dispersion": phi,
        })

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts(batches):
            yield fit_part(pdf)

    fitted = rows.mapInPandas(fit, "feature_id string, log_fc double, log_cpm double, lr double, dispersion double")
    tested = bh_adjust(fitted.withColumn("p_value", chi2_sf(F.col("lr"))))
    return tested.select("feature_id", "log_fc", "log_cpm", "lr", "p_value", "fdr", "dispersion")


def pseudobulk(matrix: DataFrame, cells: DataFrame) -> DataFrame:
    """Sum cells to samples, the sample-level form of a random intercept per sample."""
    return matrix.join(cells.select("cell_id", "sample_id"), "cell_id").groupBy("feature_id", "sample_id").agg(
        F.sum("count").alias("count"))
