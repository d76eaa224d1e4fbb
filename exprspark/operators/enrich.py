"""Over-representation tests of feature lists against gene sets, and overlap tests of two lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.functions.stats import chi2_sf, hypergeom_log_sf, hypergeom_sf
from exprspark.operators.ranking import bh_adjust
from exprspark.session import stage


def overlap_counts(
    query: DataFrame, gene_sets: DataFrame, universe: DataFrame | None = None,
    min_size: int = 10, max_size: int | None = 500,
) -> DataFrame:
    """``collection, direction, term_id, k, m, n, total, genes`` for every list and every set it meets.

    ``total`` counts the distinct features of a collection (inside ``universe`` if given), ``n`` the
    listed ones among them. Sets outside the size limits are left out before the lists are joined,
    so a gene list per row is no longer than ``max_size``.
    """
    sets = gene_sets.select("collection", "term_id", "feature_id").distinct()
    if universe is not None:
        sets = sets.join(universe.select("feature_id").distinct(), "feature_id", "left_semi")
    sets = stage(sets.select("collection", "term_id", "feature_id"))
    lists = query.select("direction", "feature_id").distinct()
    sizes = sets.groupBy("collection", "term_id").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= min_size)
    if max_size is not None:
        sizes = sizes.filter(F.col("m") <= max_size)
    background = sets.select("collection", "feature_id").distinct()
    totals = background.groupBy("collection").agg(F.count(F.lit(1)).alias("total"))
    listed = background.join(lists, "feature_id").groupBy("collection", "direction").agg(F.count(F.lit(1)).alias("n"))
    hits = (
        sets.join(sizes, ["collection", "term_id"]).join(lists, "feature_id")
        .groupBy("collection", "direction", "term_id", "m")
        .agg(F.count(F.lit(1)).alias("k"), F.array_sort(F.collect_list("feature_id")).alias("genes"))
    )
    return hits.join(totals, "collection").join(listed, ["collection", "direction"]).select(
        "collection", "direction", "term_id", "k", "m", "n", "total", "genes"
    )


def storey_q(df: DataFrame, by: list[str], p: str = "p_value", adjusted: str = "p_adjust", lam: float = 0.5) -> DataFrame:
    """q-values with the share of true nulls estimated at one fixed lambda.

    A group without any p-value above lambda has no estimate: its q-values are null.
    """
    share = F.least(F.lit(1.0), F.count_if(F.col(p) > lam) / (F.count(p) * (1 - lam)))
    pi0 = df.groupBy(*by).agg(F.when(F.count_if(F.col(p) > lam) > 0, share).alias("_pi0"))
    return df.join(pi0, by).withColumn("q_value", F.col(adjusted) * F.col("_pi0")).drop("_pi0")


def ora(
    query: DataFrame, gene_sets: DataFrame, universe: DataFrame | None = None,
    min_size: int = 10, max_size: int | None = 500,
) -> DataFrame:
    """Hypergeometric over-representation of all lists and collections in one job."""
    c = overlap_counts(query, gene_sets, universe, min_size, max_size)
    t = c.withColumn("p_value", hypergeom_sf(F.col("k"), F.col("m"), F.col("n"), F.col("total")))
    t = bh_adjust(t, by=["collection", "direction"], out="p_adjust")
    t = storey_q(t, ["collection", "direction"])
    return t.select(
        "collection", "direction", "term_id",
        F.concat_ws("/", "k", "n").alias("gene_ratio"), F.concat_ws("/", "m", "total").alias("bg_ratio"),
        "p_value", "p_adjust", "q_value", F.col("k").alias("count"), "genes",
    )


def odds_ratio(k: Column, m: Column, n: Column, total: Column) -> Column:
    """Odds ratio of the 2x2 table; 0.5 is added to all cells where one of them is zero."""
    a, b, c, d = k, m - k, n - k, total - n - m + k
    half = F.when((a == 0) | (b == 0) | (c == 0) | (d == 0), 0.5).otherwise(0.0)
    return (a + half) * (d + half) / ((b + half) * (c + half))


def enrich_table(
    query: DataFrame, library: DataFrame, min_genes: int = 20, max_p: float | None = None,
    filter_on: str = "adjusted_p_value", max_size: int | None = None,
) -> DataFrame:
    """Overlap, p, adjusted p, odds ratio and combined score per list, library and term.

    Lists with fewer than ``min_genes`` distinct features are not tested. The score takes the logarithm of the
    tail itself, so it holds where the p-value is too small for a number.
    """
    lists = query.select("direction", "feature_id").distinct()
    long_enough = lists.groupBy("direction").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_genes)
    lists = lists.join(long_enough.select("direction"), "direction", "left_semi")
    c = overlap_counts(lists, library, min_size=1, max_size=max_size)
    t = c.withColumn("p_value", hypergeom_sf(F.col("k"), F.col("m"), F.col("n"), F.col("total")))
    t = t.withColumn("_log_p", hypergeom_log_sf(F.col("k"), F.col("m"), F.col("n"), F.col("total")))
    t = bh_adjust(t, by=["collection", "direction"], out="adjusted_p_value")
    t = t.withColumn("odds_ratio", odds_ratio(F.col("k"), F.col("m"), F.col("n"), F.col("total")))
    t = t.select(
        "collection", "direction", F.col("term_id").alias("term"), F.concat_ws("/", "k", "m").alias("overlap"),
        "p_value", "adjusted_p_value", "odds_ratio",
        (-F.col("_log_p") * F.col("odds_ratio")).alias("combined_score"), F.array_join("genes", "/").alias("genes"),
    )
    return t if max_p is None else t.filter(F.col(filter_on) < max_p)


def describe_terms(results: DataFrame, terms: DataFrame) -> DataFrame:
    """Attach the description of each term; results without one keep a null."""
    keys = [c for c in ("collection", "term_id") if c in results.columns and c in terms.columns]
    one = terms.groupBy(*keys).agg(F.min("description").alias("description"))
    return results.join(one, keys, "left")


def direction_lists(deg: DataFrame, with_all: bool = True) -> DataFrame:
    """ALL, UP and DN lists of a result table as ``direction, feature_id`` rows."""
    labels = [F.when(F.col("log_fc") > 0, "UP"), F.when(F.col("log_fc") < 0, "DN")]
    if with_all:
        labels.insert(0, F.lit("ALL"))
    return deg.select(F.explode(F.array_compact(F.array(*labels))).alias("direction"), "feature_id")


def overlap_test(a: DataFrame, b: DataFrame, total: int | Column, key: str = "feature_id") -> DataFrame:
    """Chi-squared test with continuity correction on the 2x2 table of two lists (null for an empty margin)."""
    total = F.lit(total) if isinstance(total, int) else total
    flags = a.select(key).distinct().withColumn("_a", F.lit(1)).join(
        b.select(key).distinct().withColumn("_b", F.lit(1)), key, "full")
    t = flags.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"),
        F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"),
    ).withColumn("neither", total - F.col("both") - F.col("only_a") - F.col("only_b"))
    w, x, y, z = (F.col(c).cast("double") for c in ("both", "only_a", "only_b", "neither"))
    n = w + x + y + z
    gap = F.greatest(F.lit(0.0), F.abs(w * z - x * y) - n / 2)
    stat = F.try_divide(n * gap * gap, (w + x) * (y + z) * (w + y) * (x + z))
    return t.withColumn("statistic", stat).withColumn("p_value", chi2_sf(F.col("statistic")))


def simplify_terms(terms: DataFrame, edges: DataFrame, cutoff: float = 0.7) -> DataFrame:
    """Greedy removal of terms too similar to a better one (smaller ``p_value``, then id).

    Each round settles all terms whose better neighbours are settled, which gives the same terms
    as going through the list one by one. ``edges`` is ``term_1, term_2, jaccard``.
    """
    order = terms.select("term_id", "p_value")
    near = edges.filter(F.col("jaccard") > cutoff)
    near = near.select("term_1", "term_2").unionByName(near.select(F.col("term_2").alias("term_1"), F.col("term_1").alias("term_2")))
    o1 = order.select(F.col("term_id").alias("term_1"), F.col("p_value").alias("p1"))
    o2 = order.select(F.col("term_id").alias("term_2"), F.col("p_value").alias("p2"))
    # worse -> better
    links = stage(
        near.join(o1, "term_1").join(o2, "term_2")
        .filter((F.col("p2") < F.col("p1")) | ((F.col("p2") == F.col("p1")) & (F.col("term_2") < F.col("term_1"))))
        .select(F.col("term_1").alias("worse"), F.col("term_2").alias("better"))
    )
    state = stage(order.select("term_id", F.lit(None).cast("boolean").alias("kept")))
    while not state.filter("kept is null").isEmpty():
        seen = links.join(state.select(F.col("term_id").alias("better"), F.col("kept").alias("bk")), "better")
        votes = seen.groupBy(F.col("worse").alias("term_id")).agg(
            F.coalesce(F.bool_or("bk"), F.lit(False)).alias("lost"), F.bool_or(F.col("bk").isNull()).alias("open"))
        settled = (
            F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("lost"), F.lit(False))
            .when(F.coalesce("open", F.lit(False)), F.lit(None).cast("boolean")).otherwise(F.lit(True))
        )
        state = stage(state.join(votes, "term_id", "left").select("term_id", settled.alias("kept")))
    return terms.join(state.filter("kept").select("term_id"), "term_id", "left_semi")
