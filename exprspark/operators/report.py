"""Ordering, top-k selections and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exprspark.functions.scalar import neg_log10, sci, truncate_label
from exprspark.operators.ranking import ordered_index


def ordered(df: DataFrame, *order: Column) -> DataFrame:
    """Sort for a sink; always ends with an id so that ties have one order."""
    return df.orderBy(*order)


def head(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows or fewer; the limit reaches every partition before the merge."""
    return df.orderBy(*order).limit(n)


def both_ends(df: DataFrame, max_n: int, order: Sequence[Column], reverse: Sequence[Column]) -> DataFrame:
    """All rows if there are at most ``max_n``, else the first half and the last half of them."""
    half = max_n // 2
    many = df.agg(F.count(F.lit(1))).scalar() > max_n
    first = df.orderBy(*order).limit(half)
    last = df.orderBy(*reverse).limit(half)
    return first.unionByName(last).filter(many).unionByName(df.filter(~many))


def capped_list(
    deg: DataFrame, max_n: int, p_cut: float, order: Sequence[Column], fdr_only: bool = False
) -> DataFrame:
    """If more than ``max_n`` rows pass the test cutoff take the first ``max_n``, else filter by FDR.

    The test uses the raw p-value, or with ``fdr_only`` the adjusted one.
    """
    passing = F.col("fdr") < p_cut if fdr_only else F.col("p_value") < p_cut
    many = deg.agg(F.count_if(passing)).scalar() > max_n
    capped = deg.orderBy(*order).limit(max_n).filter(many)
    return capped.unionByName(deg.filter(~many & (F.col("fdr") < p_cut)))


def bounded_top(df: DataFrame, sig: Column, lower: int, upper: int, order: Sequence[Column]) -> DataFrame:
    """As many first rows as there are significant ones, but at least ``lower`` and at most ``upper``."""
    n = F.least(F.greatest(df.agg(F.count_if(sig)).scalar(), F.lit(lower)), F.lit(upper))
    top = df.orderBy(*order).limit(upper)
    place = F.row_number().over(W.orderBy(*order))  # at most `upper` rows here
    return top.withColumn("place", place).filter(F.col("place") <= n)


def top_per_group(df: DataFrame, by: Sequence[str], n: int, order: Sequence[Column], ties: bool = False) -> DataFrame:
    """First n rows of each group; Spark limits every group before the shuffle. ``ties`` keeps equal rows."""
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("place", fn.over(W.partitionBy(*by).orderBy(*order))).filter(F.col("place") <= n)


def first_distinct(df: DataFrame, key: str, n: int, order: str) -> DataFrame:
    """The first n distinct keys in the order of their best row."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order)).orderBy(order, key).limit(n)


def rank_rows(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1..n after sorting, for any number of rows."""
    return ordered_index(df, order, out=out)


def ranked_list(
    deg: DataFrame, mapping: DataFrame | None = None, by: str = "log_fc", max_n: int | None = None
) -> DataFrame:
    """ALL, UP and DN ranked lists in one table: ``list, feature_id, score, rank``.

    ``by`` is ``log_fc``, ``lr`` or ``p_value`` (score ``-log10 p``, finite for p = 0). The cap takes
    the largest absolute fold changes, or the smallest p-values.
    """
    d = deg
    if max_n is not None:
        first = F.col("p_value") if by == "p_value" else -F.abs(F.col(by))
        d = d.orderBy(first, "feature_id").limit(max_n)
    if mapping is not None:
        m = mapping.select("feature_id", "target").filter("target is not null").distinct()
        d = d.join(m, "feature_id").withColumn("feature_id", F.col("target")).drop("target")
    score = neg_log10("p_value") if by == "p_value" else F.col(by)
    lists = F.array_compact(F.array(
        F.lit("ALL"), F.when(F.col("log_fc") > 0, "UP"), F.when(F.col("log_fc") < 0, "DN")
    ))
    rows = d.select("feature_id", score.alias("score"), F.explode(lists).alias("list")).dropna()
    one = rows.groupBy("list", "feature_id").agg(F.max_by("score", F.abs("score")).alias("score"))
    return ordered_index(one, [F.col("score").desc(), F.col("feature_id")], by=["list"])


def comparison_table(
    first: DataFrame, second: DataFrame, p: str = "p_adjust", signed: bool = True
) -> DataFrame:
    """Signed -log10 p of the terms of two enrichment runs; null where a run lacks the term."""
    def side(df, name):
        v = neg_log10(p)
        if signed:
            v = v * F.when(F.col("nes") > 0, 1.0).otherwise(-1.0)
        return df.select("term_id", v.alias(name))

    return side(first, "log10p_1").join(side(second, "log10p_2"), "term_id", "full")


def figure_rows(
    df: DataFrame, p: str, label: str, n: int, p_cut: float, order: Sequence[Column],
    sign_of: str | None = None, width: int = 50,
) -> DataFrame:
    """Bars of an enrichment figure: filter by p, first n rows, signed -log10 p, short label."""
    v = neg_log10(p)
    if sign_of:
        v = v * F.when(F.col(sign_of) > 0, 1.0).otherwise(-1.0)
    return (
        df.filter(F.col(p) <= p_cut).orderBy(*order).limit(n)
        .select(label, v.alias("log10p"), truncate_label(label, width).alias("short_label"))
    )


def format_deg(deg: DataFrame) -> DataFrame:
    """Report form: two digits, p-values in scientific notation."""
    return deg.select(*[
        F.bround(c, 2).alias(c) if c in ("log_fc", "log_cpm", "lr")
        else sci(c).alias(c) if c in ("p_value", "fdr") else F.col(c)
        for c in deg.columns
    ])


def round_numeric(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every floating column."""
    return df.select(*[F.bround(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def interleave(first: dict[str, DataFrame], second: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Alternate two ordered sets of named tables of equal length."""
    if len(first) != len(second):
        raise ValueError("the two lists of tables differ in length")
    out: dict[str, DataFrame] = {}
    for a, b in zip(first.items(), second.items()):
        out.update((a, b))
    return out
