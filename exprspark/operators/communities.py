"""Communities of a weighted graph by modularity at a resolution, level by level.

A graph is a table ``(u, v, w)`` of node names that holds every link in both directions with a whole-number weight; ``(u, u, w)``
carries twice the weight of a loop. Sums of weights are whole numbers, so results do not depend on partitioning.

On each level every node starts on its own and moves to the neighbouring community with the largest gain in modularity, a
share of the nodes at a time, until a round gains little. A round that does not raise modularity is taken back and repeated with
half the share. Then communities become the nodes of the next level's graph, until a level gains nothing. From there the nodes of the first graph
move again, starting from the communities found, and so on until that gains nothing either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.operators.cells import knn
from exprspark.operators.ranking import ordered_index
from exprspark.session import stage

#: weight of a pair with equal neighbour sets
UNIT = 1_000_000
#: a level that gains less ends the search, a round that gains less ends its level; the smallest share of nodes that is tried
GAIN, ROUND_GAIN, LEAST_SHARE = 1e-5, 2e-4, 1 / 4
#: behind a node's name: the community that it alone began
ALONE = "\x01"


def shared_neighbours(vectors: DataFrame, k: int = 20, prune: float = 1 / 15) -> DataFrame:
    """``a, b, w`` with a < b: pairs of near neighbours and the share of neighbours they have in common.

    A cell's set is itself and its ``k`` - 1 nearest; ``w`` is intersection over union of two sets in millionths. Pairs
    at or under ``prune`` are left out. Only pairs of which one is in the other's set are compared, so a cell in very many
    sets costs one row for each, not a product.
    """
    near = knn(vectors, vectors, k).select(F.col("query_id").alias("a"), F.col("ref_id").alias("b"))
    near = stage(near.filter("a <> b").unionByName(vectors.select(F.col("cell_id").alias("a"), F.col("cell_id").alias("b"))))
    # at most k rows a cell; with ties at a distance of 0 the cell itself can be missing among its k nearest
    sets = stage(near.groupBy("a").agg(F.collect_set("b").alias("s")))
    pairs = stage(near.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    left = stage(pairs.join(sets, "a"))
    both = left.join(sets.select(F.col("a").alias("b"), F.col("s").alias("t")), "b")
    common = F.size(F.array_intersect("s", "t"))
    share = common / (F.size("s") + F.size("t") - common)
    return both.filter(share > prune).select("a", "b", F.round(share * UNIT).cast("long").alias("w"))


def as_graph(pairs: DataFrame) -> DataFrame:
    """Both directions of ``a, b, w``; repeated pairs are added up, a loop counts twice."""
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")
    return pairs.unionByName(turned).groupBy(F.col("a").alias("u"), F.col("b").alias("v")).agg(F.sum("w").alias("w"))


def modularity(graph: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Share of the weight inside communities, less ``resolution`` times what their total weights let expect.

    ``labels`` is ``node, community``. A graph without weight has 0.
    """
    at = labels.select(F.col("node").alias("u"), F.col("community").alias("cu"))
    to = labels.select(F.col("node").alias("v"), F.col("community").alias("cv"))
    sums = graph.join(at, "u").join(to, "v").groupBy("cu").agg(
        F.sum("w").cast("double").alias("tot"), F.sum(F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(0)).alias("inside"))
    t = sums.agg(F.sum("tot").alias("all"), F.sum("inside").alias("inside"), F.sum(F.col("tot") * F.col("tot")).alias("squares")).first()
    return t["inside"] / t["all"] - resolution * t["squares"] / t["all"] ** 2 if t["all"] else 0.0


def _plan(graph: DataFrame, nodes: DataFrame, total: float, resolution: float) -> DataFrame:
    """``node, degree, community, best, inside, weight`` for every node: the community it wants (null: it stays), its weight
    into its own community and, once per community, that community's total.
    """
    weights = stage(nodes.groupBy("community").agg(F.sum("degree").alias("weight"), F.min("node").alias("head")))
    placed = stage(nodes.join(weights, "community"))
    far = placed.select(F.col("node").alias("v"), F.col("community").alias("to"), F.col("weight").alias("to_weight"))
    votes = graph.join(far, "v").groupBy("u", "to").agg(
        F.sum(F.when(F.col("u") != F.col("v"), F.col("w")).otherwise(0)).alias("links"), F.sum("w").alias("all"), F.max("to_weight").alias("to_weight"))
    own = placed.withColumnRenamed("node", "u")
    pull = F.lit(resolution) * F.col("degree") / F.lit(total)
    mine = F.col("to") == F.col("community")
    gain = F.col("links") - pull * (F.col("to_weight") - F.when(mine, F.col("degree")).otherwise(0))
    told = votes.join(own, "u").withColumn("gain", gain).withColumn("mine", mine)
    best = told.groupBy("u").agg(
        F.max(F.when(~F.col("mine"), F.struct("gain", F.col("to_weight").alias("by"), "to"))).alias("best"),
        F.max(F.when(F.col("mine"), F.col("gain"))).alias("stay"), F.max(F.when(F.col("mine"), F.col("all"))).alias("inside"))
    stay = F.coalesce("stay", -pull * (F.col("weight") - F.col("degree")))
    # nodes that move at once can end where none of them gains: such a node may also leave for a community of its own
    better = F.col("best.gain") > stay + 1e-9
    wanted = F.when(better & (F.col("best.gain") >= 0), F.col("best.to")).when(stay < -1e-9, F.concat("u", F.lit(ALONE))).when(better, F.col("best.to"))
    return own.join(best, "u", "left").select(
        F.col("u").alias("node"), "degree", "community", wanted.alias("best"),
        F.coalesce("inside", F.lit(0)).alias("inside"), F.when(F.col("u") == F.col("head"), F.col("weight")).alias("weight"))


@dataclass
class Level:
    """What one level ended with: its modularity, its rounds, and its table ``node, community``."""

    modularity: float
    rounds: int
    labels: DataFrame


def _one_level(graph: DataFrame, total: float, resolution: float, level: int, start: DataFrame | None = None) -> Level:
    nodes = graph.groupBy(F.col("u").alias("node")).agg(F.sum("w").alias("degree"))
    nodes = stage(nodes.withColumn("community", F.col("node")) if start is None else nodes.join(start, "node"))
    share, rounds, kept, quality = 0.6, 0, None, None
    while True:
        plan = stage(_plan(graph, nodes, total, resolution))
        t = plan.agg(F.sum("inside").alias("inside"), F.sum(F.col("weight").cast("double") * F.col("weight")).alias("squares"), F.count("best").alias("movers"),
            F.min(F.when(F.col("best").isNotNull(), F.xxhash64("node", F.lit(level), F.lit(rounds)))).alias("least")).first()
        now = t["inside"] / total - resolution * t["squares"] / total**2
        if kept is None or now > quality:
            slow = kept is not None and now - quality < ROUND_GAIN
            kept, quality, movers, least, seen = plan, now, t["movers"], t["least"], rounds
        else:
            slow, share = False, share / 2
        if slow or not movers or share < LEAST_SHARE:
            return Level(quality, rounds, kept.select("node", "community"))
        # one mover always moves, so that few of them are not passed over
        drawn = F.pmod(F.xxhash64("node", F.lit(level), F.lit(rounds)), F.lit(1 << 20)) < int(share * (1 << 20))
        turn = drawn | (F.xxhash64("node", F.lit(level), F.lit(seen)) == F.lit(least))
        nodes = kept.select("node", "degree", F.when(turn, F.coalesce("best", "community")).otherwise(F.col("community")).alias("community"))
        rounds += 1


def _contracted(graph: DataFrame, labels: DataFrame) -> DataFrame:
    """The graph between communities; weights inside one become its loop."""
    at = labels.select(F.col("node").alias("u"), F.col("community").alias("cu"))
    to = labels.select(F.col("node").alias("v"), F.col("community").alias("cv"))
    half = stage(graph.join(at, "u").select("cu", "v", "w"))
    return stage(half.join(to, "v").groupBy(F.col("cu").alias("u"), F.col("cv").alias("v")).agg(F.sum("w").alias("w")))


def levels(graph: DataFrame, resolution: float = 1.0) -> list[Level]:
    """The levels from the nodes of ``graph`` up, each with labels for the nodes of ``graph``; modularity rises from level to level."""
    graph = stage(graph)
    total = graph.agg(F.sum("w")).first()[0]
    out: list[Level] = []
    gained = bool(total)
    while gained:
        at, gained, start = graph, False, out[-1].labels if out else None
        while True:
            level = _one_level(at, float(total), resolution, len(out), start)
            if out and level.modularity <= out[-1].modularity + GAIN:
                break
            labels = stage(level.labels)
            whole = labels if not gained else stage(out[-1].labels.withColumnRenamed("community", "_c").join(
                labels.select(F.col("node").alias("_c"), "community"), "_c").select("node", "community"))
            out.append(Level(level.modularity, level.rounds, whole))
            at, gained, start = _contracted(at, labels), True, None
    return out


def modularity_clusters(vectors: DataFrame, resolution: float = 0.8, k: int = 20, prune: float = 1 / 15) -> DataFrame:
    """``cell_id, cluster``: communities of the shared-neighbour graph at a resolution, numbered from the largest ("0") on.

    A higher resolution gives more and smaller clusters. Equal sizes are numbered by smallest cell id; a cell without
    links is a cluster of its own.
    """
    vectors = stage(vectors.select("cell_id", "vec"))
    found = levels(as_graph(shared_neighbours(vectors, k, prune)), resolution)
    cells = vectors.select("cell_id")
    if found:
        labels = found[-1].labels.select(F.col("node").alias("cell_id"), "community")
        named = stage(cells.join(labels, "cell_id", "left").withColumn("community", F.coalesce("community", "cell_id")))
    else:
        named = stage(cells.withColumn("community", F.col("cell_id")))
    sizes = stage(named.groupBy("community").agg(F.count("*").alias("size"), F.min("cell_id").alias("first")))
    numbered = ordered_index(sizes, [F.desc("size"), F.asc("first")], out="no").select("community", (F.col("no") - 1).cast("string").alias("cluster"))
    return named.join(numbered, "community").select("cell_id", "cluster")
