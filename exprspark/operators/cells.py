"""Single-cell operators on sparse counts ``(feature_id, cell_id, count)`` and cell vectors ``(cell_id, vec)``.

Zeros stay absent: shares, ranks and variances add the zero block by its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exprspark.functions.stats import normal_two_sided
from exprspark.operators.ranking import average_rank, bh_adjust, exact_quantiles, value_ranks
from exprspark.operators.report import top_per_group
from exprspark.session import spread, stage


FEATURE_PARTS = 32  # that the features of a sample are dealt over


def merge_samples(parts: Sequence[DataFrame]) -> DataFrame:
    """One table of all samples; barcodes become unique by their sample id."""
    merged = reduce(DataFrame.unionByName, parts)
    return merged.withColumn("cell_id", F.concat_ws("_", "sample_id", "barcode")).drop("barcode").select(
        "cell_id", *[c for c in merged.columns if c != "barcode"])


def cell_qc(matrix: DataFrame, mito: str = "^MT-") -> DataFrame:
    """Features, counts and percent of counts in mitochondrial features per cell, in one aggregation."""
    return matrix.filter("count > 0").groupBy("cell_id").agg(
        F.count(F.lit(1)).alias("n_feature"), F.sum("count").alias("n_count"),
        (F.sum(F.when(F.col("feature_id").rlike(mito), F.col("count")).otherwise(0.0)) * 100 / F.sum("count")).alias("percent_mt"),
    )


def qc_filter(qc: DataFrame, min_feature: int = 200, max_feature: int = 10_000, max_mt: float = 17.4) -> DataFrame:
    return qc.filter((F.col("n_feature") > min_feature) & (F.col("n_feature") < max_feature) & (F.col("percent_mt") < max_mt))


def confidence_filter(
    scores: DataFrame, classes: Sequence[str], min_score: float = 0.5, min_margin: float = 0.65,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Cells with a clear best class: highest score above ``min_score`` and margin to the second above ``min_margin``.

    ``scores`` has one column per class. Adds ``predicted_id``, ``max_score``, ``second_score``, ``margin``.
    """
    ranked = F.sort_array(F.array(*[F.struct(F.col(c).alias("s"), F.lit(-i).alias("o"), F.lit(c).alias("c")) for i, c in enumerate(classes)]), asc=False)
    t = scores.withColumn("_r", ranked).select(
        *scores.columns, F.col("_r")[0]["c"].alias("predicted_id"), F.col("_r")[0]["s"].alias("max_score"),
        F.col("_r")[1]["s"].alias("second_score"))
    t = t.withColumn("margin", F.try_divide(F.col("max_score") - F.col("second_score"), F.col("max_score")))
    t = t.filter((F.col("max_score") > min_score) & (F.col("margin") > min_margin))
    return t if keep is None else t.filter(F.col("predicted_id").isin(list(keep)))


def majority_label(cells: DataFrame, cluster: str, label: str) -> DataFrame:
    """The most frequent label of each cluster (ties: smaller label)."""
    n = cells.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy(cluster).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(label))).alias("b"), F.sum("n").alias("size"))
    return best.select(cluster, F.col(f"b.{label}").alias(label), (-F.col("b.n")).alias("n"), "size")


def pct_expressed(matrix: DataFrame, cells: DataFrame, group: str = "group") -> DataFrame:
    """Share of the cells of each group with a count above zero, and the highest share per feature."""
    size = cells.groupBy(group).agg(F.count(F.lit(1)).alias("_cells"))
    nnz = matrix.filter("count > 0").join(cells.select("cell_id", group), "cell_id").groupBy("feature_id", group).agg(
        F.count(F.lit(1)).alias("_nnz"))
    return nnz.join(size, group).select("feature_id", group, (F.col("_nnz") / F.col("_cells")).alias("pct"))


def expressed_in_any(pct: DataFrame, min_pct: float = 0.1) -> DataFrame:
    """Features whose highest group share reaches the limit."""
    return pct.groupBy("feature_id").agg(F.max("pct").alias("max_pct")).filter(F.col("max_pct") >= min_pct)


def detection_rate(matrix: DataFrame) -> DataFrame:
    """Detected features per cell, centred and scaled over cells."""
    n = stage(matrix.filter("count > 0").groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_feature")))
    m = n.agg(F.struct(F.avg("n_feature").alias("mu"), F.stddev_samp("n_feature").alias("sd"))).scalar()
    return n.withColumn("_m", m).select(
        "cell_id", "n_feature", F.try_divide(F.col("n_feature") - F.col("_m.mu"), F.col("_m.sd")).alias("detection_rate"))


def find_markers(
    matrix: DataFrame, clusters: DataFrame, value: str = "value", min_pct: float = 0.25, min_log_fc: float = 0.25
) -> DataFrame:
    """One-against-rest rank-sum test of every feature and cluster, positive changes only.

    Cells are summed up to (feature, cluster, value) counts first. The zeros of a feature are one tie
    at the bottom, so their ranks and their share of the tie correction come from their number.
    ``avg_log2_fc`` is the difference of ``log2(mean + 1)``.
    """
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n1"))
    total = clusters.agg(F.count(F.lit(1))).scalar()
    cells = stage(
        matrix.filter(F.col(value) > 0).join(clusters.select("cell_id", "cluster"), "cell_id")
        .groupBy("feature_id", "cluster", F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    )
    ranks = value_ranks(cells, ["feature_id"], "v", weight="c").select(
        "feature_id", "v", F.col("n").alias("t"), "below", F.col("total").alias("nnz"))
    per_feature = cells.groupBy("feature_id").agg(
        F.sum("c").alias("nnz"), F.sum(F.col("c") * F.col("v")).alias("sum_all"))
    t = F.col("t").cast("double")
    ties = ranks.groupBy("feature_id").agg(F.sum(t * t * t - t).alias("ties"))
    within = cells.join(ranks.select("feature_id", "v", "t", "below"), ["feature_id", "v"]).groupBy("feature_id", "cluster").agg(
        F.sum("c").alias("k"), F.sum(F.col("c") * F.col("v")).alias("s"),
        F.sum(F.col("c") * (F.col("below") + (F.col("t") + 1) / 2)).alias("rank_nz"),
    )
    x = within.join(per_feature, "feature_id").join(ties, "feature_id").join(sizes, "cluster").withColumn("n", total)
    z = (F.col("n") - F.col("nnz")).cast("double")
    n1, n2 = F.col("n1").cast("double"), (F.col("n") - F.col("n1")).cast("double")
    # zeros: rank (z+1)/2 each; non-zeros are lifted by z
    rank_sum = (n1 - F.col("k")) * (z + 1) / 2 + F.col("rank_nz") + F.col("k") * z
    u = rank_sum - n1 * (n1 + 1) / 2
    n = F.col("n").cast("double")
    all_ties = F.col("ties") + z * z * z - z
    var = n1 * n2 / 12 * ((n + 1) - F.try_divide(all_ties, n * (n - 1)))
    mean_1, mean_2 = F.col("s") / n1, F.coalesce(F.try_divide(F.col("sum_all") - F.col("s"), n2), F.lit(0.0))
    x = x.select(
        "cluster", "feature_id", F.col("k").alias("k"), (F.col("k") / n1).alias("pct_1"),
        F.coalesce(F.try_divide(F.col("nnz") - F.col("k"), n2), F.lit(0.0)).alias("pct_2"),
        (F.log2(mean_1 + 1) - F.log2(mean_2 + 1)).alias("avg_log2_fc"), u.alias("u"),
        F.when(var > 0, (u - n1 * n2 / 2) / F.sqrt(var)).otherwise(0.0).alias("z"),
    ).drop("k")
    kept = x.filter((F.greatest("pct_1", "pct_2") >= min_pct) & (F.col("avg_log2_fc") >= min_log_fc))
    return bh_adjust(kept.withColumn("p_value", normal_two_sided(F.col("z"))), by=["cluster"])


def top_markers(markers: DataFrame, n: int = 20) -> DataFrame:
    """The n largest changes per cluster; ties at the limit are kept."""
    return top_per_group(markers, ["cluster"], n, [F.col("avg_log2_fc").desc()], ties=True)


def _residual(x: Column, mu: Column, theta: float, clip: Column) -> Column:
    raw = (x - mu) / F.sqrt(mu + mu * mu / theta)
    return F.greatest(F.least(raw, clip), -clip)


def _totals(matrix: DataFrame, cells: DataFrame):
    m = matrix.filter("count > 0").join(cells.select("cell_id", "sample_id"), "cell_id")
    m = stage(m.select("sample_id", "feature_id", "cell_id", "count"))
    by_cell = m.groupBy("sample_id", "cell_id").agg(F.sum("count").alias("cell_total"))
    by_feature = m.groupBy("sample_id", "feature_id").agg(F.sum("count").alias("feature_total"))
    by_sample = by_cell.groupBy("sample_id").agg(
        F.sum("cell_total").alias("total"), F.sqrt(F.count(F.lit(1)).cast("double")).alias("clip"))
    return m, by_cell, by_feature, by_sample


def normalize_cells(matrix: DataFrame, cells: DataFrame, theta: float = 100.0) -> DataFrame:
    """Analytic Pearson residuals per sample: ``(x - mu) / sqrt(mu + mu^2 / theta)``, clipped.

    Returned for the present pairs together with ``zero_residual``, the value an absent pair of the
    same feature and cell would have.
    """
    return _residuals(*_totals(matrix, cells), theta)


def _residuals(m: DataFrame, by_cell: DataFrame, by_feature: DataFrame, by_sample: DataFrame, theta: float) -> DataFrame:
    mu = F.col("feature_total") * F.col("cell_total") / F.col("total")
    x = m.join(by_cell, ["sample_id", "cell_id"]).join(by_feature, ["sample_id", "feature_id"]).join(by_sample, "sample_id")
    return x.select(
        "sample_id", "feature_id", "cell_id", _residual(F.col("count"), mu, theta, F.col("clip")).alias("residual"),
        _residual(F.lit(0.0), mu, theta, F.col("clip")).alias("zero_residual"))


def residual_variance(matrix: DataFrame, cells: DataFrame, theta: float = 100.0) -> DataFrame:
    """Variance of the residuals per sample and feature over all cells of the sample.

    The zero residual depends on the cell only through its total, so the zero block of a feature is
    a sum over the distinct cell totals of its sample, not over cells. The totals are copied to the parts that
    a sample's features are dealt over, so that a large sample is not one key.
    """
    m, by_cell, by_feature, by_sample = _totals(matrix, cells)
    res = _residuals(m, by_cell, by_feature, by_sample, theta)
    present = res.groupBy("sample_id", "feature_id").agg(
        F.sum(F.col("residual") - F.col("zero_residual")).alias("d1"),
        F.sum(F.col("residual") * F.col("residual") - F.col("zero_residual") * F.col("zero_residual")).alias("d2"))
    hist = by_cell.groupBy("sample_id", "cell_total").agg(F.count(F.lit(1)).alias("w"))
    mu = F.col("feature_total") * F.col("cell_total") / F.col("total")
    zero = _residual(F.lit(0.0), mu, theta, F.col("clip"))
    dealt = by_feature.withColumn("_part", F.pmod(F.xxhash64("feature_id"), F.lit(FEATURE_PARTS)))
    copied = hist.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(FEATURE_PARTS - 1).cast("long"))))
    zeros = dealt.join(copied, ["sample_id", "_part"]).join(by_sample, "sample_id").groupBy("sample_id", "feature_id").agg(
        F.sum(F.col("w") * zero).alias("z1"), F.sum(F.col("w") * zero * zero).alias("z2"), F.sum("w").alias("n"))
    s1, s2, n = F.col("z1") + F.col("d1"), F.col("z2") + F.col("d2"), F.col("n")
    return zeros.join(present, ["sample_id", "feature_id"]).filter("n > 1").select(
        "sample_id", "feature_id", ((s2 - s1 * s1 / n) / (n - 1)).alias("variance"))


def select_features(variance: DataFrame, n: int = 10_000, top: int | None = None) -> DataFrame:
    """Features that are most often among the ``top`` most variable of a sample, then by median rank."""
    v = variance.withColumn("_neg", -F.round("variance", 9))
    ranked = average_rank(stage(v), "_neg", by=["sample_id"], out="r")
    hits = ranked.filter(F.col("r") <= (top or n))
    med = exact_quantiles(hits, ["feature_id"], "r", {"median_rank": 0.5})
    return med.withColumnRenamed("n", "n_samples").orderBy(F.col("n_samples").desc(), "median_rank", "feature_id").limit(n)


def _euclid(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def _within(a: np.ndarray, b: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that may be among the ``k`` nearest of ``a`` and within its ``limit``, by one matrix product.

    The product's distances are off by rounding, so all that might be inside is kept; the caller measures these exactly.
    """
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    d = aa[:, None] + bb - 2 * (a @ b.T)
    off = (a.shape[1] + 16) * 1e-15 * (aa + bb.max(where=np.isfinite(bb), initial=0))
    if len(b) > k and not np.isfinite(limit).all():
        limit = np.fmin(limit, np.sqrt(np.maximum(np.partition(d, k - 1, axis=1)[:, k - 1] + off, 0)))
    return np.nonzero(~(d > ((limit + 2e-9) ** 2 + off)[:, None]))  # not a number is kept


PIVOT_VALUES = 1 << 24  # numbers in all pivots that are broadcast together (128 MB)
LOADS, FOUND = 32, 1 << 22  # most blocks' worth of vectors on a side of a task; candidates that a task holds before the best are kept


class _Tree:
    """Two levels of pivots for every key: a few top pivots, and under each the pivots nearest to it."""

    def __init__(self, pivots: pd.DataFrame):
        self.keys: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.size = len(pivots)
        first = 0
        for key, part in pivots.groupby("key", sort=True):
            centre = np.stack(part["rv"].to_numpy()).astype(float)
            tops = centre[: max(1, int(len(centre) ** 0.5))]
            owner = _euclid(centre, tops).argmin(axis=1)
            ids = np.arange(first, first + len(centre), dtype=np.int32)
            first += len(centre)
            self.keys[key] = [(tops[t], centre[owner == t], ids[owner == t]) for t in range(len(tops)) if (owner == t).any()]

    def place(self, key: str, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pivot that each vector belongs to, by way of its nearest top; distances to the pivot and to the top."""
        branches = self.keys[key]
        far = _euclid(x, np.stack([top for top, _, _ in branches]))
        at = far.argmin(axis=1)
        pivot, near = np.empty(len(x), np.int32), np.empty(len(x))
        for t in np.unique(at):
            rows = np.flatnonzero(at == t)
            d = _euclid(x[rows], branches[t][1])
            pivot[rows], near[rows] = branches[t][2][d.argmin(axis=1)], d.min(axis=1)
        return pivot, near, far[np.arange(len(x)), at]

    def reach(self, key: str, x: np.ndarray, bound: np.ndarray, radius: np.ndarray, cover: np.ndarray) -> list[np.ndarray]:
        """Pivots whose ball may hold something within ``bound``; a top whose cover is out of reach closes all of its pivots."""
        found: list[list[np.ndarray]] = [[] for _ in x]
        for top, centre, ids in self.keys[key]:
            rows = np.flatnonzero(_euclid(x, top[None])[:, 0] - cover[ids].max() <= bound + 1e-6)
            if rows.size:
                open_ = (_euclid(x[rows], centre) - radius[ids] <= bound[rows, None] + 1e-6) & np.isfinite(radius[ids])
                for i, o in zip(rows.tolist(), open_):
                    if o.any():
                        found[i].append(ids[o])
        return [np.concatenate(f) if f else np.zeros(0, np.int32) for f in found]


def knn(
    queries: DataFrame, reference: DataFrame, k: int, pivots: int | None = None, block: int = 2048, by: str | None = None, pairs=None,
) -> DataFrame:
    """Exact k nearest reference vectors: ``query_id, ref_id, distance, place``.

    Both tables are ``cell_id, vec``; with ``by`` both also have that column, and a query meets the references of its key
    only (``query_id`` may then occur once for each key, and the key is returned as ``by``).

    A key's references are dealt to pivots, some of them chosen by hash, about half the root of their number, which are found through a
    level of top pivots. A query first searches the blocks of its own pivot, whose k-th distance bounds the answer;
    then only the pivots whose ball can hold something closer, and only under tops whose cover can. Pivots with many members
    are cut into blocks of bounded size on both sides, those with few share a group of that size, and a task multiplies two blocks
    pivot by pivot and keeps k rows per query, so neither all pairs nor a large group ever exist. ``pairs`` is an accumulator that counts the products.
    """
    spark = queries.sparkSession
    key = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    r = stage(reference.select(key.alias("key"), F.col("cell_id").alias("id"), F.col("vec").alias("v")))
    q = queries.select(key.alias("key"), F.col("cell_id").alias("id"), F.col("vec").alias("v"))
    sizes = {row["key"]: row["count"] for row in r.groupBy("key").count().collect()}  # one row a key
    schema = "key string, query_id string, ref_id string, distance double, place int"
    if not sizes:
        return _named(spark.createDataFrame([], schema), by)
    width = len(r.select("v").first()["v"])
    share = min(1.0, PIVOT_VALUES / max(1, width) / sum(int(n ** 0.5) + 1 for n in sizes.values()))
    wanted = {x: min(n, pivots) if pivots else 1 if n <= block else max(1, int(n ** 0.5 * share) // 2) for x, n in sizes.items()}
    order = F.row_number().over(W.partitionBy("key").orderBy(F.xxhash64("id"), "id"))
    chosen = r.withColumn("nth", order).filter(F.col("nth") <= max(wanted.values())).select("key", F.col("v").alias("rv"), "nth").toPandas()
    chosen = chosen[chosen["nth"] <= chosen["key"].map(wanted)].sort_values(["key", "nth"])
    branches = _Tree(chosen)
    tree = spark.sparkContext.broadcast(branches)

    def nearest(batches):
        for pdf in batches:
            for name, part in pdf.groupby("key", sort=False):
                if name in tree.value.keys:
                    pivot, d, top = tree.value.place(name, np.stack(part["v"].to_numpy()).astype(float))
                    yield part.assign(pivot=pivot, d=d, top=top)

    dealt = "key string, id string, v array<double>, pivot int, d double, top double"
    r, q = stage(r.mapInPandas(nearest, dealt)), stage(q.mapInPandas(nearest, dealt))
    ball = r.groupBy("pivot").agg(F.max("d").alias("radius"), F.max("top").alias("cover"), F.count(F.lit(1)).alias("n"))
    shape = ball.toPandas()  # one row per pivot
    radius, cover = np.full(len(chosen), -np.inf), np.full(len(chosen), -np.inf)
    radius[shape["pivot"]], cover[shape["pivot"]] = shape["radius"], shape["cover"]
    # neighbouring pivots share a group of up to ``load`` members: a query travels to a group once, not to each of its pivots
    # and each side of a task is copied as many times as the other has groups, so groups grow with the table while a task can hold them
    load = max(block, min(LOADS * block, sum(sizes.values()) // 16))
    members, group, now = np.zeros(len(chosen), np.int64), np.zeros(len(chosen), np.int32), -1
    members[shape["pivot"]] = shape["n"]
    for name in sorted(branches.keys):
        held = load + 1
        for p in np.concatenate([ids for _, _, ids in branches.keys[name]]):
            if held + members[p] > load:
                now, held = now + 1, 0
            group[p], held = now, held + members[p]
    blocks = np.maximum(1, -(-np.bincount(group, members).astype(int) // load))
    dealt_to = spark.createDataFrame(pd.DataFrame({"pivot": shape["pivot"], "grp": group[shape["pivot"]]}), "pivot int, grp int")
    cut = spark.createDataFrame(pd.DataFrame({"grp": np.arange(len(blocks)), "blocks": blocks}), "grp int, blocks int")
    r = r.join(dealt_to, "pivot").join(cut, "grp").select("id", "v", "pivot", "grp", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("rb"))

    def search(routes: DataFrame) -> DataFrame:
        """k best per query and block of a group, for ``key, id, v, bound, grp, pivots`` routes; nothing beyond ``bound`` is needed."""
        routes = routes.join(cut, "grp").select("key", "id", "v", "bound", "grp", "pivots", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("rb"))
        loads = routes.groupBy("grp", "rb").agg(F.ceil(F.count(F.lit(1)) / F.lit(load)).alias("_b"))
        salted = routes.join(loads, ["grp", "rb"]).withColumn("qb", F.pmod(F.xxhash64("id"), F.col("_b")).cast("int"))
        copies = r.join(loads, ["grp", "rb"]).select(
            F.col("grp").alias("grp"), F.col("rb").alias("rb"), "id", "v", "pivot", F.explode(F.sequence(F.lit(0), (F.col("_b") - 1).cast("int"))).alias("qb"))

        def multiply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            none = pd.DataFrame({"key": [], "query_id": [], "ref_id": [], "distance": []})
            if left.empty or right.empty:
                return none
            right = right.sort_values(["pivot", "id"])
            a = np.stack(left["v"].to_numpy()).astype(float)
            b = np.stack(right["v"].to_numpy()).astype(float)
            asked = np.concatenate(left["pivots"].to_list())
            row = np.repeat(np.arange(len(left)), [len(x) for x in left["pivots"]])[np.argsort(asked, kind="stable")]
            asked = np.sort(asked)
            named = np.empty(len(right), int)
            named[np.argsort(right["id"].to_numpy(), kind="stable")] = np.arange(len(right))

            def nearest_of(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                query, ref, distance = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((named[ref], distance, query))
                query, ref, distance = query[order], ref[order], distance[order]
                keep = np.arange(len(query)) - np.searchsorted(query, query) < k
                return query[keep], ref[keep], distance[keep]

            found, held = [], 0
            limit = left["bound"].to_numpy(dtype=float)
            pivot, begin = np.unique(right["pivot"].to_numpy(), return_index=True)
            for p, lo, hi in zip(pivot, begin, [*begin[1:], len(right)]):
                rows, part = row[np.searchsorted(asked, p):np.searchsorted(asked, p, "right")], b[lo:hi]
                if pairs is not None:
                    pairs.add(int(len(rows) * len(part)))
                step = max(1, 4_000_000 // max(part.size, 1))  # differences of some queries at a time
                for i in range(0, len(rows), step):
                    some = rows[i:i + step]
                    one, at = _within(a[some], part, k, limit[some])
                    d = np.round(np.sqrt(((part[at] - a[some[one]]) ** 2).sum(axis=1)), 9)
                    order = np.lexsort((at, d, one))
                    one, at, d = one[order], at[order], d[order]
                    nth = np.arange(len(one)) - np.searchsorted(one, one)
                    last = nth == k - 1  # a query with k rows needs nothing beyond the last of them
                    limit[some[one[last]]] = np.fmin(limit[some[one[last]]], d[last])
                    found.append((some[one[nth < k]], lo + at[nth < k], d[nth < k]))
                    held += len(found[-1][0])
                    if held > max(FOUND, 2 * k * len(left)):
                        found = [nearest_of(found)]
                        held = len(found[0][0])
            if not found:
                return none
            query, ref, distance = nearest_of(found)
            return pd.DataFrame({
                "key": left["key"].to_numpy()[query], "query_id": left["id"].to_numpy()[query], "ref_id": right["id"].to_numpy()[ref], "distance": distance})

        keys = ("grp", "rb", "qb")
        return spread(salted, *keys).groupBy(*keys).cogroup(spread(copies, *keys).groupBy(*keys)).applyInPandas(
            multiply, "key string, query_id string, ref_id string, distance double")

    best = [F.col("distance"), F.col("ref_id")]
    first = top_per_group(search(q.join(dealt_to, "pivot").select("key", "id", "v", F.lit(float("inf")).alias("bound"), "grp", F.array("pivot").alias("pivots"))), ["key", "query_id"], k, best)
    if len(chosen) == len(sizes):  # one pivot a key: all has been searched
        return _named(first, by)
    first = stage(first)
    bound = stage(first.groupBy("key", "query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound")))
    todo = q.join(bound, (q.id == bound.query_id) & (q.key == bound.key), "left").select(
        q.key, "id", "v", F.col("pivot").alias("home"), F.coalesce("bound", F.lit(float("inf"))).alias("bound"))

    def reach(batches):
        for pdf in batches:
            for name, part in pdf.groupby("key", sort=False):
                open_ = tree.value.reach(name, np.stack(part["v"].to_numpy()).astype(float), part["bound"].to_numpy(), radius, cover)
                others = [o[o != h] for o, h in zip(open_, part["home"])]
                grps = [np.unique(group[o]) for o in others]
                yield pd.DataFrame({"key": part["key"], "id": part["id"], "v": part["v"], "bound": part["bound"], "grps": [g.tolist() for g in grps],
                                    "pivots": [[o[group[o] == x].tolist() for x in g] for o, g in zip(others, grps)]})

    # one row a query is written, not one for each group with a copy of its vector
    routes = stage(todo.mapInPandas(reach, "key string, id string, v array<double>, bound double, grps array<int>, pivots array<array<int>>")).select(
        "key", "id", "v", "bound", F.explode(F.arrays_zip("grps", "pivots")).alias("_r")).select("key", "id", "v", "bound", F.col("_r.grps").alias("grp"), "_r.pivots")
    both = first.select("key", "query_id", "ref_id", "distance").unionByName(search(routes))
    return _named(top_per_group(both, ["key", "query_id"], k, best), by)


def _named(found: DataFrame, by: str | None) -> DataFrame:
    return found.withColumnRenamed("key", by) if by else found.drop("key")


def transfer_labels(reference: DataFrame, queries: DataFrame, k: int = 15) -> DataFrame:
    """Label scores of query cells from their nearest reference cells, weights ``1 / (1 + distance)``.

    Returns ``cell_id, predicted_id, max_score, scores`` (a map from label to score).
    """
    near = knn(queries, reference, k).join(
        reference.select(F.col("cell_id").alias("ref_id"), "label"), "ref_id").withColumn("w", 1 / (1 + F.col("distance")))
    votes = near.groupBy("query_id", "label").agg(F.sum("w").alias("w"))
    total = votes.groupBy("query_id").agg(F.sum("w").alias("_t"))
    scored = votes.join(total, "query_id").select("query_id", "label", F.round(F.col("w") / F.col("_t"), 9).alias("score"))
    return scored.groupBy(F.col("query_id").alias("cell_id")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("label"))).alias("b"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "score")))).alias("scores"),
    ).select("cell_id", F.col("b.label").alias("predicted_id"), (-F.col("b.s")).alias("max_score"), "scores")


def _mean_vectors(rows: DataFrame, by: str, vec: str, out: str) -> DataFrame:
    """The element-wise mean of ``vec`` for each ``by``: the vectors are summed up by component, never gathered."""
    parts = rows.select(by, F.posexplode(vec).alias("i", "g")).groupBy(by, "i").agg(F.avg("g").alias("g"))
    return parts.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("i", "g"))).alias("s")).select(by, F.col("s.g").alias(out))


def integrate_samples(vectors: DataFrame, sample: str, reference: str, k: int = 5, smooth: int = 5) -> DataFrame:
    """Move every sample onto the reference sample along its mutual nearest neighbours.

    Pairs that are among each other's ``k`` nearest give a difference vector; a cell is shifted by
    the mean of the vectors at its ``smooth`` nearest paired cells of the same sample. A sample without pairs stays.

    All samples go through the same passes at once: the neighbour searches are keyed by sample. The samples hang on the
    reference as on the root of a tree of depth one.
    """
    cells = stage(vectors.select("cell_id", F.col(sample).cast("string").alias("_s"), "vec"))
    base, own = cells.filter(F.col("_s") == reference), cells.filter(F.col("_s") != reference)
    ab = stage(knn(own, base, k).select(F.col("query_id").alias("a"), F.col("ref_id").alias("b")))
    # a reference cell is looked up in the samples that named it only
    named = ab.join(own.select(F.col("cell_id").alias("a"), "_s"), "a").select(F.col("b").alias("cell_id"), "_s").distinct()
    asked = named.join(base.select("cell_id", "vec"), "cell_id")
    ba = knn(asked, own, k, by="_s").select(F.col("query_id").alias("b"), F.col("ref_id").alias("a"))
    mutual = ab.join(ba, ["a", "b"])
    pairs = mutual.join(own.select(F.col("cell_id").alias("a"), F.col("vec").alias("va")), "a").join(
        base.select(F.col("cell_id").alias("b"), F.col("vec").alias("vb")), "b")
    shifts = stage(_mean_vectors(pairs.select("a", F.zip_with("vb", "va", lambda x, y: x - y).alias("g")), "a", "g", "shift"))
    anchors = own.join(shifts.select(F.col("a").alias("cell_id")), "cell_id", "left_semi")
    near = knn(own, anchors, smooth, by="_s").join(shifts.withColumnRenamed("a", "ref_id"), "ref_id")
    mean = stage(_mean_vectors(near, "query_id", "shift", "shift").withColumnRenamed("query_id", "cell_id"))
    moved = F.zip_with("vec", "shift", lambda x, y: x + y)
    placed = cells.join(mean, "cell_id", "left").select("cell_id", F.coalesce(moved, "vec").alias("vec"))
    return vectors.select("cell_id", sample).join(placed, "cell_id").select("cell_id", sample, "vec")


def cluster_cells(vectors: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """k-means clusters of cell vectors, a distributed stand-in for graph communities."""
    v = vectors.select("cell_id", array_to_vector("vec").alias("features"))
    model = KMeans(k=k, seed=seed).fit(v)
    return model.transform(v).select("cell_id", F.col("prediction").cast("string").alias("cluster"))


def neighbour_communities(vectors: DataFrame, k: int = 10, max_rounds: int = 200) -> DataFrame:
    """Communities of the k-nearest-neighbour graph by label propagation, run until no cell wants another label.

    A cell wants the label of most of its neighbours (ties: smaller label) if that has more votes than its
    own. In each round a half of the cells, drawn anew by hash, may change, so neighbours do not swap labels
    for ever. A graph that has not settled after ``max_rounds`` raises.
    """
    near = knn(vectors, vectors, k + 1).filter("query_id <> ref_id").select("query_id", "ref_id")
    both = stage(near.unionByName(near.select(F.col("ref_id").alias("query_id"), F.col("query_id").alias("ref_id"))).distinct())
    labels = stage(vectors.select("cell_id", F.col("cell_id").alias("cluster")))
    for i in range(max_rounds):
        votes = both.join(labels.select(F.col("cell_id").alias("ref_id"), "cluster"), "ref_id").groupBy(
            F.col("query_id").alias("cell_id"), "cluster").agg(F.count(F.lit(1)).alias("n"))
        own = labels.withColumnRenamed("cluster", "old")
        best = votes.join(own, "cell_id").groupBy("cell_id").agg(
            F.min(F.struct((-F.col("n")).alias("n"), F.col("cluster"))).alias("b"), F.max(F.when(F.col("cluster") == F.col("old"), F.col("n"))).alias("mine"))
        wants = F.coalesce(-F.col("b.n") > F.coalesce("mine", F.lit(0)), F.lit(False))
        turn = F.pmod(F.xxhash64("cell_id", F.lit(i)), F.lit(2)) == 0
        new = stage(own.join(best, "cell_id", "left").select(
            "cell_id", F.when(wants & turn, F.col("b.cluster")).otherwise(F.col("old")).alias("cluster"), wants.alias("wants")))
        labels = new.select("cell_id", "cluster")
        if new.filter("wants").isEmpty():
            return labels
    raise RuntimeError(f"communities did not settle in {max_rounds} rounds")
