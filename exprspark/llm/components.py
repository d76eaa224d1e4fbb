"""Connected components of a link table by alternating star steps, each a pair of joins, written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest; ``edges`` have u > v."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node that it reaches. Nodes without links are left out.

    Minima are aggregated before the shuffle, written, and joined back: with two tables as they are Spark splits the links of
    a node that has very many of them.
    Rounds end when nothing moves; their number grows with the logarithm of the longest chain.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = stage(links.filter("a <> b").select(high.alias("u"), low.alias("v")).distinct())
    mark = lambda df: df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    before = mark(edges)
    while before["n"]:
        edges = stage(_small_star(_large_star(edges)))
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
