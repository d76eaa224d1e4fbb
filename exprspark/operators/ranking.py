"""Ranks, quantiles, running sums and multiple-testing adjustment without one-task windows.

Every function here first collapses equal values to one row with a count, then splits each group
into tiles of neighbouring values. A window only ever sees one tile, and a second small window sees
the tile totals. So neither a group nor a value that holds a third of all rows meets one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exprspark.session import stage

TILES = 64
FEW = 4096  # distinct values that a group holds in one tile


def value_ranks(
    df: DataFrame, by: Sequence[str], value: str, weight: str | None = None, tiles: int = TILES,
) -> DataFrame:
    """One row per distinct value of each group: ``by, value, tile, n, below, total``.

    ``below`` counts the rows with a smaller value, so the average rank of a tie is
    ``below + (n + 1) / 2`` and the last rank is ``below + n``. Null and NaN values have no rank. Only groups of
    more than ``FEW`` distinct values are cut into tiles, so very many small groups cost one sort.
    """
    by = list(by)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    distinct = stage(df.filter(known).groupBy(*by, value).agg(n.alias("n")))
    marks = F.percentile_approx(value, [i / tiles for i in range(1, tiles)])
    if by:
        large = distinct.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > FEW).select(*by)
        cut = distinct.join(distinct.join(large, by, "left_semi").groupBy(*by).agg(marks.alias("cuts")), by, "left")
    else:
        cut = distinct.withColumn("cuts", distinct.agg(marks.alias("cuts")).scalar())
    tile = F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda c: c < F.col(value))))
    tiled = cut.withColumn("tile", tile).drop("cuts")
    totals = tiled.groupBy(*by, "tile").agg(F.sum("n").alias("tile_n"))
    earlier = W.partitionBy(*by).orderBy("tile").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "tile",
        F.coalesce(F.sum("tile_n").over(earlier), F.lit(0)).alias("before"),
        F.sum("tile_n").over(W.partitionBy(*by)).alias("total"),
    )
    inside = W.partitionBy(*by, "tile").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        tiled.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, [*by, "tile"])
        .select(*by, value, "tile", "n", (F.col("before") + F.col("inside")).alias("below"), "total")
    )


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
    weight: str | None = None, tiles: int = TILES,
) -> DataFrame:
    """Exact interpolated quantiles (the ``percentile`` definition) for groups of any size."""
    ranks = value_ranks(df, by, value, weight, tiles)

    def at(pos: Column) -> Column:
        hit = (F.col("below") <= pos) & (pos < F.col("below") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    cols = []
    for name, p in probs.items():
        h = (F.col("total") - 1) * F.lit(float(p))
        cols += [at(F.floor(h)).alias(f"_lo_{name}"), at(F.ceil(h)).alias(f"_hi_{name}")]
    g = ranks.groupBy(*by).agg(*cols, F.max("total").alias("total"))
    out = [F.col(c) for c in by]
    for name, p in probs.items():
        h = (F.col("total") - 1) * F.lit(float(p))
        frac = h - F.floor(h)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * frac).alias(name))
    return g.select(*out, F.col("total").alias("n"))


def bh_adjust(
    df: DataFrame, p: str = "p_value", by: Sequence[str] = (), out: str = "fdr", tiles: int = TILES,
) -> DataFrame:
    """Benjamini-Hochberg: ``min over p_j >= p_i of p_j * n / j``, at most 1, per ``by`` group.

    Rows with a null or NaN p-value keep a null result and are not counted. The tests are staged once.
    Equal p-values share the last rank of their value, which gives the same minimum, and tiles carry
    the minimum of all later tiles.
    """
    by = list(by)
    tests = stage(df)
    raw = value_ranks(tests, by, p, tiles=tiles).withColumn(
        "raw", F.least(F.lit(1.0), F.col(p) * F.col("total") / (F.col("below") + F.col("n")))
    )
    from_top = W.partitionBy(*by, "tile").orderBy(F.col(p).desc()).rowsBetween(W.unboundedPreceding, 0)
    tile_min = raw.groupBy(*by, "tile").agg(F.min("raw").alias("tile_min"))
    later = W.partitionBy(*by).orderBy("tile").rowsBetween(1, W.unboundedFollowing)
    later_min = tile_min.select(*by, "tile", F.min("tile_min").over(later).alias("later_min"))
    adjusted = (
        raw.withColumn("in_min", F.min("raw").over(from_top))
        .join(later_min, [*by, "tile"])
        .select(*by, p, F.least("in_min", "later_min").alias(out))
    )
    return tests.join(adjusted, [*by, p], "left").select(*df.columns, out)


def ordered_index(
    df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), out: str = "rank"
) -> DataFrame:
    """1..n in the given order, globally or per ``by`` group; the order must be total.

    The rows are range-sorted over all tasks and written once; the position inside each sorted
    partition plus the row count of earlier partitions is the index. Nothing but the partition
    counts passes through one task.
    """
    by = list(by)
    low = F.lit((1 << 33) - 1)
    ordered = stage(df.orderBy(*by, *order).withColumn("_mid", F.monotonically_increasing_id()))
    part = ordered.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_pos", F.col("_mid").bitwiseAND(low))
    counts = part.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    indexed = part.join(offsets, "_part").withColumn(out, F.col("_off") + F.col("_pos") + 1)
    if by:
        first = indexed.groupBy(*by).agg(F.min(out).alias("_first"))
        indexed = indexed.join(first, by).withColumn(out, F.col(out) - F.col("_first") + 1)
    return indexed.select(*df.columns, out)


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "avg_rank") -> DataFrame:
    """Rank by value where ties share the mean of their ranks."""
    by = list(by)
    r = value_ranks(df, by, value).select(*by, value, (F.col("below") + (F.col("n") + 1) / 2).alias(out))
    return df.join(r, [*by, value], "left").select(*df.columns, out)


def mean_of_ranks(df: DataFrame, first: str, second: str, id_col: str) -> DataFrame:
    """Order rows by the mean of their ranks in two columns."""
    both = average_rank(average_rank(df, first, out="rank_1"), second, out="rank_2")
    return both.withColumn("mean_rank", (F.col("rank_1") + F.col("rank_2")) / 2).orderBy("mean_rank", id_col)


def sweep(
    events: DataFrame, keys: Sequence[str], deltas: Sequence[str], pos: str = "pos", tile: int = 1 << 20,
    xors: Sequence[str] = (), one_per_pos: bool = False,
) -> DataFrame:
    """Running sums over positions: ``keys, start, end, <running deltas>`` segments.

    ``events`` holds one signed change per row. Changes at one position are summed before the
    shuffle, positions without a net change vanish (so equal neighbours are one segment), and a
    sequence is cut into tiles of ``tile`` positions whose totals are carried over. The last
    position of a sequence has no end and is not returned. ``xors`` columns run as exclusive-or, where
    adding and removing a code are the same and nothing overflows. ``one_per_pos`` says that every
    change is a step of one however often its position occurs.
    """
    keys, deltas, xors = list(keys), list(deltas), list(xors)
    values = [*deltas, *xors]

    def total(c: str) -> Column:
        return F.bit_xor(c) if c in xors else F.sum(c)

    def plus(a: Column, b: Column, c: str) -> Column:
        return a.bitwiseXOR(b) if c in xors else a + b

    e = events.groupBy(*keys, pos).agg(*[(F.max(d) if one_per_pos else total(d)).alias(d) for d in values])
    changed = F.lit(False)
    for d in values:
        changed = changed | (F.col(d) != 0)
    # A tile that cannot be null leaves the two uses of `e` with equal filters, so that the second
    # one reuses the first one's shuffle instead of scanning again.
    e = e.filter(changed).withColumn("_tile", F.coalesce(F.floor(F.col(pos) / F.lit(tile)), F.lit(0)))
    seq = W.partitionBy(*keys, "_tile").orderBy(pos)
    run = seq.rowsBetween(W.unboundedPreceding, 0)
    inner = e.select(
        *keys, "_tile", pos, F.lead(pos).over(seq).alias("_next"),
        *[total(d).over(run).alias(d) for d in values],
    )
    tiles = e.groupBy(*keys, "_tile").agg(
        F.min(pos).alias("_first"), *[total(d).alias(d) for d in values]
    )
    tseq = W.partitionBy(*keys).orderBy("_tile")
    trun = tseq.rowsBetween(W.unboundedPreceding, -1)
    carry = tiles.select(
        *keys, "_tile", F.lead("_first").over(tseq).alias("_later"),
        *[F.coalesce(total(d).over(trun), F.lit(0)).alias(f"_c_{d}") for d in values],
    )
    return (
        inner.join(carry, [*keys, "_tile"])
        .select(
            *keys, F.col(pos).alias("start"), F.coalesce("_next", "_later").alias("end"),
            *[plus(F.col(d), F.col(f"_c_{d}"), d).alias(d) for d in values],
        )
        .filter(F.col("end").isNotNull())
    )
