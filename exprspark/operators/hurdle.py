"""Two-part model for cells with any covariates: logistic on detection, Gaussian on the values of detecting cells.

What depends on detecting cells only (products of covariates with each other and with the values) is summed by Spark once,
from the sparse table. What depends on all cells are the logistic model's weights: in every Newton round a task multiplies
tiles of cells with the coefficients of a block of features, and hands on p x p sums per feature, never a cell. Features
that have settled leave the rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.functions.stats import chi2_sf
from exprspark.operators.ranking import bh_adjust
from exprspark.session import spread, stage

#: features whose coefficients are broadcast at a time; cells x features that a task multiplies at a time
BLOCK_FEATURES, TILE = 20_000, 1_000_000
ROUNDS, SETTLED = 50, 1e-9
Z_95 = 1.959963984540054


def detection_rate(matrix: DataFrame, cells: DataFrame, value: str = "count") -> DataFrame:
    """``cells`` with ``detection``: the number of features a cell detects, centred and scaled over these cells."""
    found = matrix.filter(F.col(value) > 0).groupBy("cell_id").agg(F.count(F.lit(1)).alias("_n"))
    counted = stage(cells.join(found, "cell_id", "left").withColumn("_n", F.coalesce("_n", F.lit(0))))
    moments = counted.agg(F.avg("_n").alias("_mean"), F.stddev_samp("_n").alias("_sd"))
    scaled = F.coalesce(F.try_divide(F.col("_n") - F.col("_mean"), F.col("_sd")), F.lit(0.0))
    return counted.join(F.broadcast(moments)).withColumn("detection", scaled).drop("_n", "_mean", "_sd")


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def _square(sums: np.ndarray, keep: Sequence[int], p: int) -> np.ndarray:
    """Features x pairs as symmetric matrices over the kept terms."""
    at = {pair: c for c, pair in enumerate(_pairs(p))}
    order = [[at[min(i, j), max(i, j)] for j in keep] for i in keep]
    return sums[:, np.array(order)]


def _solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverses, solutions and whether each matrix has full rank."""
    size = np.abs(a).max(axis=(1, 2), initial=0.0)
    full = np.isfinite(a).all(axis=(1, 2)) & (size > 0)
    safe = np.where(full[:, None, None], a, np.eye(a.shape[1]))
    full &= np.linalg.matrix_rank(safe, hermitian=True) == a.shape[1]
    inverse = np.linalg.inv(np.where(full[:, None, None], a, np.eye(a.shape[1])))
    return inverse, np.einsum("fij,fj->fi", inverse, b), full


def _round_batches(shared, p: int):
    """Reads cells as columns x0.., gives per feature and model the sums of one Newton round over this task's cells."""
    first, second = (np.array(x) for x in zip(*_pairs(p), strict=True))
    width = first.size + p + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, beta = shared.value  # beta: two models x terms x features
        sums = np.zeros((2, width, len(ids)))
        step = max(1, TILE // max(1, len(ids)))
        for b in batches:
            x = np.column_stack([b.column(f"x{i}").to_numpy() for i in range(p)])
            both = x[:, first] * x[:, second]
            for at in range(0, len(x), step):
                xs, xx = x[at:at + step], both[at:at + step]
                for m in (0, 1):
                    eta = np.clip(xs @ beta[m], -30, 30)
                    mu = 1 / (1 + np.exp(-eta))
                    sums[m, :first.size] += xx.T @ (mu * (1 - mu))
                    sums[m, first.size:-1] += xs.T @ mu
                    sums[m, -1] += np.log1p(np.exp(eta)).sum(axis=0)
        flat = sums.reshape(2 * width, -1)
        yield pa.record_batch([pa.array(ids, pa.string()), *(pa.array(r) for r in flat)], ["feature_id", *(f"c{i}" for i in range(2 * width))])

    return run


def _floats(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy().reshape(-1, width)


def _lists(values: np.ndarray) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(np.ascontiguousarray(values, dtype=float).ravel()))


STATE = "feature_id string, products array<double>, with_value array<double>, squares double, beta array<double>, round array<double>, settled boolean, ok boolean"


def _newton_batches(p: int):
    """One Newton step of both models for every feature; a feature that cannot be fitted is marked and leaves."""
    n_pairs = p * (p + 1) // 2
    width = n_pairs + p + 1
    keeps = (list(range(p)), [0, *range(2, p)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            products, beta = _floats(b.column("products"), n_pairs), _floats(b.column("beta"), 2 * p).copy()
            sums = np.column_stack([b.column(f"c{i}").to_numpy() for i in range(2 * width)]).reshape(-1, 2, width)
            y = products[:, [_pairs(p).index((0, j)) for j in range(p)]]  # sums of the terms over detecting cells
            ok, most = np.ones(len(y), bool), np.zeros(len(y))
            for m, keep in enumerate(keeps):
                _, step, full = _solve(_square(sums[:, m, :n_pairs], keep, p), (y - sums[:, m, n_pairs:-1])[:, keep])
                ok &= full
                beta[:, np.array(keep) + m * p] += np.where(full[:, None], np.clip(step, -5, 5), 0.0)
                most = np.maximum(most, np.where(full, np.abs(step).max(axis=1), 0.0))
            yield pa.record_batch([
                b.column("feature_id"), b.column("products"), b.column("with_value"), b.column("squares"), _lists(beta), _lists(sums.reshape(len(y), -1)),
                pa.array(~ok | (most < SETTLED)), pa.array(ok),
            ], [f.split(" ")[0] for f in STATE.split(", ")])

    return run


def _result_batches(p: int, base: list[float]):
    """The two likelihood-ratio statistics, the change of the expected value with its interval, and the coefficients."""
    n_pairs = p * (p + 1) // 2
    width = n_pairs + p + 1
    all_terms, null_terms = list(range(p)), [0, *range(2, p)]
    mean = np.array(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            products, value = _floats(b.column("products"), n_pairs), _floats(b.column("with_value"), p)
            ss, beta = b.column("squares").to_numpy(), _floats(b.column("beta"), 2 * p)
            sums = _floats(b.column("round"), 2 * width).reshape(-1, 2, width)
            k = products[:, 0]
            y = products[:, [_pairs(p).index((0, j)) for j in range(p)]]
            ll = [np.einsum("fj,fj->f", beta[:, m * p:(m + 1) * p], y) - sums[:, m, -1] for m in (0, 1)]
            d_cov, _, d_full = _solve(_square(sums[:, 0, :n_pairs], all_terms, p), np.zeros((len(k), p)))
            d_ok = b.column("ok").to_numpy(zero_copy_only=False) & d_full & np.isfinite(ll[0]) & np.isfinite(ll[1]) & (np.abs(beta).max(axis=1) < 25)
            rss = []
            c_ok = k > p
            for keep in (all_terms, null_terms):
                inverse, coef, full = _solve(_square(products, keep, p), value[:, keep])
                rss.append(np.maximum(ss - np.einsum("fj,fj->f", coef, value[:, keep]), 0.0))
                c_ok &= full & (rss[-1] > 1e-12 * np.maximum(ss, 1.0))
                if keep is all_terms:
                    c_cov, c_beta = inverse, coef
            with np.errstate(divide="ignore", invalid="ignore"):
                c_cov = c_cov * (rss[0] / (k - p))[:, None, None]
                stat = np.where(d_ok, np.maximum(2 * (ll[0] - ll[1]), 0.0), 0.0) + np.where(c_ok, np.maximum(k * np.log(rss[1] / rss[0]), 0.0), 0.0)
            low, high = mean.copy(), mean.copy()
            low[1], high[1] = 0.0, 1.0
            b1 = beta[:, :p]
            at = [1 / (1 + np.exp(-np.clip(b1 @ q, -700, 700))) for q in (low, high)]
            level = [c_beta @ q for q in (low, high)]
            gd = np.outer(level[1] * at[1] * (1 - at[1]), high) - np.outer(level[0] * at[0] * (1 - at[0]), low)
            gc = np.outer(at[1], high) - np.outer(at[0], low)
            with np.errstate(invalid="ignore"):
                half = Z_95 * np.sqrt(np.maximum(np.einsum("fi,fij,fj->f", gd, d_cov, gd) + np.einsum("fi,fij,fj->f", gc, c_cov, gc), 0.0))
            change = at[1] * level[1] - at[0] * level[0]
            both, either = d_ok & c_ok, d_ok | c_ok
            nan = lambda v, ok: np.where(ok, v, np.nan)
            yield pa.record_batch([
                b.column("feature_id"), pa.array(nan(change, both)), pa.array(nan(change - half, both)), pa.array(nan(change + half, both)),
                pa.array(nan(stat, either)), pa.array(d_ok.astype(np.int32) + c_ok.astype(np.int32)), pa.array(k), pa.array(y[:, 1]),
                _lists(np.where(d_ok[:, None], b1, np.nan)), _lists(np.where(c_ok[:, None], c_beta, np.nan)),
            ], ["feature_id", "log_fc", "ci_low", "ci_high", "statistic", "df", "n_detect", "n_detect_trt", "detection_coef", "level_coef"])

    return run


def hurdle_fit(
    matrix: DataFrame, cells: DataFrame, ref: str, trt: str, covariates: Sequence[str] = (), value: str = "count",
    block_features: int = BLOCK_FEATURES,
) -> DataFrame:
    """The fits behind :func:`hurdle_de`, one row per feature, with both parts' coefficients.

    Coefficients are in the order intercept, group, covariates; those of a part that cannot be fitted are NaN.
    """
    spark = matrix.sparkSession
    p = 2 + len(covariates)
    terms = [F.lit(1.0), F.when(F.col("group") == trt, 1.0).otherwise(0.0), *(F.col(c).cast("double") for c in covariates)]
    x = stage(cells.filter(F.col("group").isin(ref, trt)).select("cell_id", *[t.alias(f"x{i}") for i, t in enumerate(terms)]))
    means = x.agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(p)], F.count("*").alias("n"), F.sum("x1").alias("n_trt")).first()
    v = F.col(value).cast("double")
    seen = matrix.filter(F.col(value) > 0).select("feature_id", "cell_id", v.alias("_v")).join(x, "cell_id")
    product = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in _pairs(p)]
    sums = stage(seen.groupBy("feature_id").agg(
        F.array(*product).alias("products"), F.array(*[F.sum(F.col(f"x{i}") * F.col("_v")) for i in range(p)]).alias("with_value"),
        F.sum(F.col("_v") * F.col("_v")).alias("squares")))
    n_blocks = max(1, math.ceil(sums.count() / block_features))
    rate = F.least(F.greatest(F.col("products")[0] / F.lit(float(means["n"] or 1)), F.lit(1e-6)), F.lit(1 - 1e-6))
    start = [F.log(rate / (1 - rate)) if i % p == 0 else F.lit(0.0) for i in range(2 * p)]
    width = 2 * (p * (p + 1) // 2 + p + 1)
    names = [f.split(" ")[0] for f in STATE.split(", ")]
    tiles = stage(spread(x.drop("cell_id")))  # few bytes, much work: dealt over all cores
    state = stage(sums.withColumn("beta", F.array(*start)).withColumn("round", F.expr("cast(null as array<double>)")).withColumn(
        "settled", F.lit(False)).withColumn("ok", F.lit(True)).withColumn("block", F.pmod(F.xxhash64("feature_id"), F.lit(n_blocks))))
    done = []
    for block in range(n_blocks):
        todo = state.filter(F.col("block") == block).select(*names)
        for _ in range(ROUNDS):
            rows = todo.select("feature_id", "beta").toArrow()  # at most a block's coefficients
            if not rows.num_rows:
                break
            beta = _floats(rows.column("beta"), 2 * p).reshape(-1, 2, p).transpose(1, 2, 0).copy()
            shared = spark.sparkContext.broadcast((rows.column("feature_id").to_pylist(), beta))
            schema = "feature_id string, " + ", ".join(f"c{i} double" for i in range(width))
            made = tiles.mapInArrow(_round_batches(shared, p), schema).groupBy("feature_id").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)])
            stepped = stage(todo.join(made, "feature_id").mapInArrow(_newton_batches(p), STATE))
            done.append(stepped.filter("settled"))
            todo = stepped.filter("not settled")
        else:
            done.append(todo)  # the last round's numbers; a part that runs off is told by its coefficients
    fitted = state.filter("false").select(*names)
    for part in done:
        fitted = fitted.unionByName(part)
    schema = ("feature_id string, log_fc double, ci_low double, ci_high double, statistic double, df int, n_detect double, n_detect_trt double, "
              "detection_coef array<double>, level_coef array<double>")
    out = fitted.mapInArrow(_result_batches(p, [means[f"x{i}"] or 0.0 for i in range(p)]), schema)
    n, n_trt = float(means["n"]), float(means["n_trt"] or 0)
    return out.select(
        "feature_id", "log_fc", "ci_low", "ci_high", "statistic", "df",
        F.try_divide(F.col("n_detect") - F.col("n_detect_trt"), F.lit(n - n_trt)).alias("pct_ref"), F.try_divide("n_detect_trt", F.lit(n_trt)).alias("pct_trt"),
        "detection_coef", "level_coef")


def hurdle_de(
    matrix: DataFrame, cells: DataFrame, ref: str, trt: str, covariates: Sequence[str] = (), value: str = "count",
) -> DataFrame:
    """Two-part test of one group against the other for every feature, with any numeric covariates per cell.

    The two likelihood-ratio statistics of the group term are added (two degrees of freedom where
    both parts can be fitted, else one). Covariates are fixed effects and may take a different value in every cell, as
    :func:`detection_rate` does; the random intercept per sample is re-aimed as ``de.pseudobulk`` plus
    ``de.differential_expression``. Returns ``feature_id, log_fc, ci_low, ci_high, statistic, df, pct_ref, pct_trt, p_value, fdr``;
    a feature that cannot be fitted has ``df`` 0 and NaN statistics.
    """
    fitted = hurdle_fit(matrix, cells, ref, trt, covariates, value).drop("detection_coef", "level_coef")
    return bh_adjust(fitted.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("df"))))
