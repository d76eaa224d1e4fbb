"""Term similarity graphs and their connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.operators.ranking import ordered_index
from exprspark.session import stage


def term_profiles(sets: DataFrame) -> DataFrame:
    """``term_id, profile, size``: terms with the same members share a profile, their smallest id.

    Members are compared by count and three independent 64-bit sums, so no set is ever collected.
    """
    f = F.col("feature_id")
    g = sets.select("term_id", "feature_id").distinct().groupBy("term_id").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64(f)).alias("h1"),
        F.bit_xor(F.xxhash64(f, F.lit("b"))).alias("h2"), F.bit_xor(F.xxhash64(F.lit("c"), f)).alias("h3"),
    )
    same = g.groupBy("size", "h1", "h2", "h3").agg(F.min("term_id").alias("profile"))
    return g.join(same, ["size", "h1", "h2", "h3"]).select("term_id", "profile", "size")


def _candidates(prefix: DataFrame, limit: Column) -> DataFrame:
    """Pairs that may reach the limit, as ``term_1 < term_2`` with sizes, from ``feature_id, term_id, size, place``.

    If the feature at these places is the first that two sets share, they share at most ``1 + min(size - place)`` features in
    all, which must be ``limit / (1 + limit)`` of the sum of both sizes. So from its place alone a set knows the largest
    partner that this feature can lead to. Sets are joined by feature and band of sizes, the smaller set going into the bands
    from its own size up to that: a feature that very many sets share meets nobody where it stands too late to matter,
    and where it does matter it is split by band.
    """
    band = lambda size: F.floor(F.log2(size.cast("double")) * 4)
    room = 1 + F.col("size") - F.col("place")
    most = F.least(F.floor(F.col("size") / limit), F.floor(room * (1 + limit) / limit + 1e-9) - F.col("size"))
    small = prefix.withColumn("_most", most).filter(F.col("_most") >= F.col("size")).select(
        "feature_id", F.col("term_id").alias("a"), F.col("size").alias("size_a"), room.alias("room_a"), "_most",
        F.explode(F.sequence(band(F.col("size")), band(F.col("_most")))).alias("band"))
    large = prefix.select("feature_id", F.col("term_id").alias("b"), F.col("size").alias("size_b"), room.alias("room_b"), band(F.col("size")).alias("band"))
    ordered = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    reach = F.least("room_a", "room_b") >= limit * (F.col("size_a") + F.col("size_b")) / (1 + limit)
    pairs = small.join(large, ["feature_id", "band"]).filter(ordered & reach & (F.col("size_b") <= F.col("_most"))).select("a", "b", "size_a", "size_b").distinct()
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(x)).otherwise(F.col(y))
    return pairs.select(pick("b", "a").alias("term_1"), pick("a", "b").alias("term_2"), pick("size_b", "size_a").alias("size_1"), pick("size_a", "size_b").alias("size_2"))


def term_similarity(sets: DataFrame, min_jaccard: float) -> tuple[DataFrame, DataFrame]:
    """All pairs of distinct profiles with a Jaccard index of at least ``min_jaccard``.

    Returns ``term_1, term_2, shared, jaccard`` over profiles, and the profile table; terms with equal
    members are one profile, so copies never multiply. Two sets that reach the limit must share one
    of their ``size - ceil(limit * size) + 1`` rarest features, so only these are joined, in bands of sizes that can reach
    the limit from there (see :func:`_candidates`), and the candidates are counted exactly.
    """
    if not 0 < min_jaccard <= 1:
        raise ValueError("min_jaccard must be above 0")
    profiles = stage(term_profiles(sets))
    own = profiles.filter("term_id = profile").select("term_id", "size")
    rows = stage(sets.select("term_id", "feature_id").distinct().join(own, "term_id"))
    freq = rows.groupBy("feature_id").agg(F.count(F.lit(1)).alias("freq"))
    placed = ordered_index(rows.join(freq, "feature_id"), [F.col("freq"), F.col("feature_id")], by=["term_id"], out="place")
    limit = F.lit(min_jaccard) - 1e-12
    candidates = _candidates(stage(
        placed.filter(F.col("place") <= F.col("size") - F.ceil(limit * F.col("size")) + 1).select("feature_id", "term_id", "size", "place")), limit)
    # the smaller set of a candidate gives its members, which are looked up in the larger one
    first_smaller = F.col("size_1") <= F.col("size_2")
    sided = candidates.withColumn("_small", F.when(first_smaller, F.col("term_1")).otherwise(F.col("term_2"))).withColumn(
        "_large", F.when(first_smaller, F.col("term_2")).otherwise(F.col("term_1")))
    members = sided.join(rows.select(F.col("term_id").alias("_small"), "feature_id"), "_small").drop("_small")
    both = members.join(rows.select(F.col("term_id").alias("_large"), "feature_id"), ["_large", "feature_id"])
    counted = both.groupBy("term_1", "term_2", "size_1", "size_2").agg(F.count(F.lit(1)).alias("shared"))
    jaccard = F.col("shared") / (F.col("size_1") + F.col("size_2") - F.col("shared"))
    edges = counted.select("term_1", "term_2", "shared", jaccard.alias("jaccard")).filter(F.col("jaccard") >= limit)
    return edges, profiles


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node, component`` (the smallest node id): neighbour minimum plus pointer jumping per round.

    ``edges`` is ``src, dst``. Every round is written to the shared folder; the number of rounds
    grows with the logarithm of the diameter.
    """
    both = stage(
        edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    )
    labels = stage(nodes.select("node", F.col("node").alias("component")).distinct())
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("src"), "component"), "src")
        lowest = near.groupBy(F.col("dst").alias("node")).agg(F.min("component").alias("_low"))
        step = labels.join(lowest, "node", "left").select(
            "node", F.col("component").alias("_old"), F.least("component", "_low").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("_next"))
        labels_new = stage(step.join(jump, "component", "left").select(
            "node", F.least("component", "_next").alias("component"), "_old"))
        done = labels_new.filter("component <> _old").isEmpty()
        labels = labels_new.select("node", "component")
        if done:
            return labels
    raise RuntimeError("components did not settle")


def similarity_network(sets: DataFrame, min_jaccard: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Edges between terms and the cluster of every term (copies join the cluster of their profile)."""
    edges, profiles = term_similarity(sets, min_jaccard)
    edges = stage(edges)
    nodes = profiles.select(F.col("profile").alias("node")).distinct()
    comp = connected_components(nodes, edges.select(F.col("term_1").alias("src"), F.col("term_2").alias("dst")))
    clusters = profiles.join(comp, F.col("profile") == F.col("node")).select("term_id", F.col("component").alias("cluster"))
    return edges, clusters


def gene_concept_edges(results: DataFrame, fold_changes: DataFrame, n: int = 5) -> DataFrame:
    """``term_id, feature_id, log_fc`` of the core features of the n best terms."""
    top = results.orderBy("p_value", "term_id").limit(n)
    pairs = top.select("term_id", F.explode("core_enrichment").alias("feature_id"))
    return pairs.join(fold_changes.select("feature_id", "log_fc"), "feature_id").select("term_id", "feature_id", "log_fc")

