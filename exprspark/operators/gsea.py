"""Preranked gene-set enrichment. Only the hits of a set are touched, never terms x features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exprspark.operators.enrich import storey_q
from exprspark.operators.ranking import bh_adjust
from exprspark.session import spread, stage

DIGITS = 9  # scores are rounded before they are compared


def running_score(ranked: DataFrame, gene_sets: DataFrame, min_size: int = 10, max_size: int = 500) -> DataFrame:
    """The running sum at the hits of each set: ``after`` and ``before`` each hit.

    ``ranked`` is ``feature_id, score, rank``. The size limit comes first, so a set is a window of
    at most ``max_size`` rows.
    """
    n = ranked.agg(F.count(F.lit(1))).scalar()
    hits = gene_sets.select("collection", "term_id", "feature_id").distinct().join(
        ranked.select("feature_id", "rank", F.abs("score").alias("w")), "feature_id")
    sizes = hits.groupBy("collection", "term_id").agg(F.count(F.lit(1)).alias("m"), F.sum("w").alias("total_w"))
    sizes = sizes.filter(F.col("m").between(min_size, max_size) & (F.col("total_w") > 0))
    seq = W.partitionBy("collection", "term_id").orderBy("rank")
    x = hits.join(sizes, ["collection", "term_id"]).withColumn("n", n).filter("m < n")
    x = x.withColumn("i", F.row_number().over(seq)).withColumn("cum", F.sum("w").over(seq))
    misses = (F.col("rank") - F.col("i")) / (F.col("n") - F.col("m"))
    return x.select(
        "collection", "term_id", "feature_id", "rank", "i", "m", "n",
        F.round(F.col("cum") / F.col("total_w") - misses, DIGITS).alias("after"),
        F.round((F.col("cum") - F.col("w")) / F.col("total_w") - misses, DIGITS).alias("before"),
    )


def enrichment_scores(running: DataFrame) -> DataFrame:
    """ES (the extreme of the running sum), the rank of the peak, the leading edge and the core features."""
    g = running.groupBy("collection", "term_id", "m", "n").agg(
        F.max("after").alias("top"), F.min("before").alias("low"),
        F.min_by(F.struct("rank", "i"), F.struct(-F.col("after"), F.col("rank"))).alias("top_at"),
        F.min_by(F.struct("rank", "i"), F.struct(F.col("before"), F.col("rank"))).alias("low_at"),
        F.array_sort(F.collect_list(F.struct("rank", "feature_id"))).alias("hits"),
    )
    up = F.col("top") >= -F.col("low")
    g = g.select(
        "collection", "term_id", "m", "n", "hits", up.alias("up"),
        F.when(up, F.col("top")).otherwise(F.col("low")).alias("es"),
        F.when(up, F.col("top_at.rank")).otherwise(F.col("low_at.rank")).alias("rank_at_max"),
        F.when(up, F.col("top_at.i")).otherwise(F.col("low_at.i")).alias("at"),
    )
    n_core = F.when(F.col("up"), F.col("at")).otherwise(F.col("m") - F.col("at") + 1).cast("int")
    core = F.when(F.col("up"), F.slice("hits", F.lit(1), n_core)).otherwise(F.slice("hits", F.col("at"), n_core))
    tags = n_core / F.col("m")
    part = F.when(F.col("up"), F.col("rank_at_max")).otherwise(F.col("n") - F.col("rank_at_max") + 1) / F.col("n")
    return g.select(
        "collection", "term_id", F.col("m").alias("set_size"), "es", "rank_at_max", tags.alias("tags"), part.alias("list"),
        (tags * (1 - part) * F.col("n") / (F.col("n") - F.col("m"))).alias("signal"),
        core.getField("feature_id").alias("core_enrichment"),
    )


def _extremes(pos: np.ndarray, w: np.ndarray, n: int, sizes: list[int]) -> list[float]:
    """The score of the first m drawn positions for every m of ``sizes``."""
    out = []
    for m in sizes:
        o = np.argsort(pos[:m])
        r, x = pos[:m][o], w[:m][o]
        cum = np.cumsum(x)
        if len(r) < m or cum[-1] <= 0 or n == m:
            out.append(0.0)
            continue
        miss = (r - np.arange(1, m + 1)) / (n - m)
        top = np.round((cum / cum[-1] - miss).max(), DIGITS)
        low = np.round(((cum - x) / cum[-1] - miss).min(), DIGITS)
        out.append(top if top >= -low else low)
    return out


def _score_batches(n: int, sizes: list[int]):
    """Reads draws sorted by permutation and hash, gives ``perm, m, es``. One permutation's draws are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perm, held = None, []

        def scored() -> pa.RecordBatch:
            es = _extremes(np.concatenate([p for p, _ in held]), np.concatenate([w for _, w in held]), n, sizes)
            return pa.record_batch([pa.array([perm] * len(sizes), pa.int32()), pa.array(sizes, pa.int32()), pa.array(es, pa.float64())], ["perm", "m", "es"])

        for b in batches:
            at = b.column("perm").to_numpy()
            pos, w = b.column("pos").to_numpy(), b.column("w").to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if perm != at[i]:
                    if held:
                        yield scored()
                    perm, held = int(at[i]), []
                held.append((pos[i:j], w[i:j]))
        if held:
            yield scored()

    return run


def null_scores(ranked: DataFrame, sizes: list[int], nperm: int, seed: int = 1) -> DataFrame:
    """``perm, m, es`` for every permutation and distinct set size.

    A permutation orders the positions by a hash of (seed, permutation, position), so it does not
    depend on the partitioning; the m first positions are the random set of size m. Hashes are uniform, so a bound on them
    keeps little more than the largest set's worth of positions before anything is sorted; should a permutation keep fewer
    than the largest set needs, the bound is doubled.
    """
    biggest, n = max(sizes), ranked.count()
    perms = spread(ranked, "rank").select(
        F.col("rank").alias("pos"), F.abs("score").alias("w"), F.explode(F.sequence(F.lit(1), F.lit(nperm))).alias("perm"))
    hashed = perms.withColumn("h", F.substring(F.md5(F.concat_ws(":", F.lit(seed), "perm", "pos").cast("binary")), 1, 16))
    need, share = min(biggest, n), (biggest + 8 * biggest**0.5 + 32) / max(n, 1)
    while True:
        drawn = hashed if share >= 1 else hashed.filter(F.col("h") < f"{int(share * 2**64):016x}")
        drawn = stage(drawn)
        least = drawn.groupBy("perm").agg(F.count(F.lit(1)).alias("k")).agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("perms")).first()
        if share >= 1 or (least["perms"] == nperm and least["k"] >= need):
            break
        share *= 2
    sorted_draws = spread(drawn, "perm", groups=nperm).sortWithinPartitions("perm", "h", "pos").select("perm", "pos", "w")
    return sorted_draws.mapInArrow(_score_batches(n, sorted(sizes)), "perm int, m int, es double")


def _against_null(scores: DataFrame, null: DataFrame) -> DataFrame:
    """``set_size, es`` of every score with how many null scores of its size and sign there are, their mean, and how many reach it.

    Scores and null scores of one size and sign are walked together from the most extreme one down.
    """
    sign = (F.col("es") >= 0).alias("up")
    null = null.select(F.col("m").cast("long").alias("set_size"), sign, F.abs("es").alias("a"), F.lit(1).alias("is_null"), F.col("es"))
    asked = scores.select(F.col("set_size").cast("long").alias("set_size"), sign, F.abs("es").alias("a"), F.lit(0).alias("is_null"), "es").distinct()
    walk = W.partitionBy("set_size", "up").orderBy(F.desc("a"), F.desc("is_null")).rowsBetween(W.unboundedPreceding, 0)
    reached = null.unionByName(asked).withColumn("more", F.sum("is_null").over(walk)).filter("is_null = 0")
    totals = null.groupBy("set_size", "up").agg(F.count(F.lit(1)).alias("same"), F.avg("a").alias("mean_abs"))
    return reached.join(totals, ["set_size", "up"], "left").select(
        "set_size", "es", "more", F.coalesce("same", F.lit(0)).alias("same"), "mean_abs")


def gsea(
    ranked: DataFrame, gene_sets: DataFrame, nperm: int = 1000, min_size: int = 10,
    max_size: int = 500, seed: int = 1,
) -> DataFrame:
    """ES, NES, p, adjusted p, q, peak rank, leading edge and core features per collection and term."""
    ranked = stage(ranked.select("feature_id", "score", "rank"))
    scores = stage(enrichment_scores(running_score(ranked, gene_sets, min_size, max_size)))
    sizes = [row["set_size"] for row in scores.select("set_size").distinct().collect()]  # at most max_size values
    if sizes:
        told = _against_null(scores, stage(null_scores(ranked, sizes, nperm, seed)))
    else:
        told = scores.select("set_size", "es", F.lit(0).alias("more"), F.lit(0).alias("same"), F.lit(0.0).alias("mean_abs"))
    t = scores.join(told, ["set_size", "es"])
    t = t.withColumn("p_value", (1 + F.col("more")) / (1 + F.col("same")))
    t = t.withColumn("nes", F.when(F.col("same") > 0, F.col("es") / F.col("mean_abs"))).drop("same", "more", "mean_abs")
    t = bh_adjust(t, by=["collection"], out="p_adjust")
    return storey_q(t, ["collection"]).select(
        "collection", "term_id", "set_size", "es", "nes", "p_value", "p_adjust", "q_value",
        "rank_at_max", "tags", "list", "signal", "core_enrichment",
    )
