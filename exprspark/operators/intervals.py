"""Genomic intervals, alignments and coverage. Intervals are half-open and 0-based everywhere.

Overlaps are never planned as a range join: intervals become signed events on a line, or pieces in
equal bins that are joined by equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exprspark.functions.stats import poisson_sf
from exprspark.operators.ranking import bh_adjust, exact_quantiles, sweep
from exprspark.session import stage

# Alignment flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE = 1, 2, 4, 8, 16
SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048
REMOVE_FLAGS, REMOVE_FLAGS_KEEP_DUPLICATES = 3332, 2308
CHROMOSOMES = "chr[1-9,X,Y]"  # found anywhere in the name
PART_ROWS = 1 << 20  # spots of a tile that one window sees
TILE_ROWS, WIDEST = 1 << 12, 1 << 20  # intervals that a tile should hold on average; positions it may span for that


def has_bits(flag: str | Column, bits: int) -> Column:
    c = F.col(flag) if isinstance(flag, str) else flag
    return c.bitwiseAND(F.lit(bits)) == bits


def cigar_blocks(cigar: Column, start: Column) -> Column:
    """The aligned stretches of a record: an array of ``ref`` (position of the first base), ``at`` (its place in the read, from
    1) and ``n`` (bases). Insertions and soft clips move along the read, deletions and skips along the reference.
    """
    def walk(state: Column, op: Column) -> Column:
        n, kind = op.substr(F.lit(1), F.length(op) - 1).cast("int"), F.right(op, F.lit(1))
        aligned, on_read, on_ref = kind.isin("M", "=", "X"), kind.isin("I", "S"), kind.isin("D", "N")
        block = F.struct(state["ref"].alias("ref"), state["at"].alias("at"), n.alias("n"))
        return F.struct(
            (state["ref"] + F.when(aligned | on_ref, n).otherwise(0)).alias("ref"), (state["at"] + F.when(aligned | on_read, n).otherwise(0)).alias("at"),
            F.when(aligned, F.concat(state["blocks"], F.array(block))).otherwise(state["blocks"]).alias("blocks"))

    first = F.struct(start.cast("long").alias("ref"), F.lit(1).alias("at"), F.array().cast("array<struct<ref: bigint, at: int, n: int>>").alias("blocks"))
    ops = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.aggregate(ops, first, walk, lambda state: state["blocks"])


def _clipped(cigar: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(F.regexp_extract(F.coalesce(cigar, F.lit("")), pattern, 1), F.lit(r"(\d+)[SH]"), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def five_prime(df: DataFrame) -> Column:
    """The 5' end of a record: its start, or its end on the reverse strand. With a ``cigar`` column clipped bases are added back."""
    start, end = F.col("start"), F.col("end")
    if "cigar" in df.columns:
        start = start - _clipped(F.col("cigar"), r"^((?:\d+[SH])+)")
        end = end + _clipped(F.col("cigar"), r"((?:\d+[SH])+)$")
    return F.when(F.col("strand") == "-", end).otherwise(start)


def filter_alignments(
    df: DataFrame, min_mapq: int = 20, require: int = 0, remove: int = REMOVE_FLAGS, chrom: str | None = CHROMOSOMES
) -> DataFrame:
    """Alignments by quality, required flag bits, forbidden flag bits and chromosome pattern."""
    out = df.filter(
        (F.col("mapq") >= min_mapq) & has_bits("flag", require) & (F.col("flag").bitwiseAND(F.lit(remove)) == 0))
    return out if chrom is None else out.filter(F.col("chrom").rlike(chrom))


def cutsites(df: DataFrame) -> DataFrame:
    """Transposase cut position: ``[start+4, start+5)`` forward, ``[end-5, end-4)`` reverse."""
    fwd = F.col("strand") == "+"
    start = F.when(fwd, F.col("start") + 4).otherwise(F.col("end") - 5)
    return df.withColumn("_s", start).withColumn("start", F.col("_s")).withColumn("end", F.col("_s") + 1).drop("_s")


def slop(df: DataFrame, sizes: DataFrame, n: int) -> DataFrame:
    """Extend both sides by n inside ``[0, chromosome size]``."""
    return df.join(sizes.select("chrom", "size"), "chrom").withColumn(
        "start", F.greatest(F.col("start") - n, F.lit(0))).withColumn(
        "end", F.least(F.col("end") + n, F.col("size"))).drop("size").select(*df.columns)


def fragments(df: DataFrame, size: int | None = None) -> DataFrame:
    """One fragment per read of a fixed size in strand direction, or one per pair from TLEN.

    A pair is taken from its leftmost mate (positive TLEN).
    """
    if size is None:
        pairs = df.filter(F.col("tlen") > 0)
        return pairs.withColumn("end", F.col("start") + F.col("tlen"))
    fwd = F.col("strand") == "+"
    return df.withColumn("_s", F.when(fwd, F.col("start")).otherwise(F.greatest(F.col("end") - size, F.lit(0)))).withColumn(
        "end", F.when(fwd, F.col("start") + size).otherwise(F.col("end"))).withColumn("start", F.col("_s")).drop("_s")


def _events(df: DataFrame, keys: Sequence[str], weight: Column) -> DataFrame:
    edge = F.explode(F.array(
        F.struct(F.col("start").alias("pos"), weight.alias("delta")),
        F.struct(F.col("end").alias("pos"), (-weight).alias("delta")),
    ))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.filter((F.col("start") < F.col("end")) & known).select(*keys, edge.alias("_e")).select(*keys, "_e.pos", "_e.delta")


def _width(df: DataFrame, keys: Sequence[str], tile: int, beyond: bool = False) -> int:
    """Positions of a tile: ``tile``, or more where so few intervals lie in it that nearly each would have a tile of its own.

    Segments do not depend on the width, only the number of tiles whose totals are carried over does. A tile has at most ``WIDEST``
    positions, so that a window is bounded; ``beyond`` lets it have more where no sequence has more edges than that.
    """
    if tile >= WIDEST and not beyond:
        return tile
    length = F.max("end").cast("double") - F.min("start").cast("double")
    spans = df.filter(F.col("start") < F.col("end")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), length.alias("w"))
    n, w, most = spans.agg(F.sum("n"), F.sum("w"), F.max("n")).first()
    if (n or 0) < TILE_ROWS:
        return tile
    wide = int(w) * TILE_ROWS // n
    return max(tile, wide if beyond and 2 * most <= WIDEST else min(WIDEST, wide))


def coverage(
    df: DataFrame, keys: Sequence[str] = ("chrom",), scale: DataFrame | None = None,
    sizes: DataFrame | None = None, tile: int = 1 << 20,
) -> DataFrame:
    """Depth segments ``keys, start, end, value``.

    ``sizes`` (``chrom, size``) adds the zero-depth segments of every sequence, also of those without any
    interval: each sample gets all sequences. ``scale`` is a table ``sample_id, multiplier`` applied to
    the integer depth at the end.
    """
    keys = list(keys)
    tile = _width(df, keys, tile)
    events = _events(df, keys, F.lit(1).cast("long"))
    if sizes is None:
        seg = sweep(events, keys, ["delta"], tile=tile).filter("delta <> 0")
    else:
        # a second channel with one step per sequence end keeps the zero stretches
        seqs, others = sizes.select("chrom", "size"), [k for k in keys if k != "chrom"]
        if others:  # every sample has every sequence, which is part of the result
            seqs = df.select(*others).distinct().crossJoin(seqs)
        frame = seqs.select(*keys, F.explode(F.array(
            F.struct(F.lit(0).cast("long").alias("pos"), F.lit(1).cast("long").alias("inside")),
            F.struct(F.col("size").cast("long").alias("pos"), F.lit(-1).cast("long").alias("inside")),
        )).alias("_e")).select(*keys, "_e.pos", "_e.inside", F.lit(0).cast("long").alias("delta"))
        both = events.withColumn("inside", F.lit(0).cast("long")).unionByName(frame)
        seg = sweep(both, keys, ["delta", "inside"], tile=tile).filter("inside > 0")
    out = seg.select(*keys, "start", "end", F.col("delta").cast("double").alias("value"))
    if scale is not None:
        out = out.join(scale.select("sample_id", "multiplier"), "sample_id").withColumn(
            "value", F.col("value") * F.col("multiplier")).drop("multiplier").select(*keys, "start", "end", "value")
    return out


def merge_intervals(df: DataFrame, keys: Sequence[str] = ("chrom",), min_length: int = 0, tile: int = 1 << 20) -> DataFrame:
    """Union of intervals: overlapping and touching ones become one."""
    keys = list(keys)
    tile = _width(df, keys, tile)
    depth = sweep(_events(df, keys, F.lit(1).cast("long")), keys, ["delta"], tile=tile).filter("delta > 0")
    # the covered segments touch inside an island, so their inner edges cancel
    islands = sweep(_events(depth, keys, F.lit(1).cast("long")), keys, ["delta"], tile=tile).filter("delta > 0")
    return islands.select(*keys, "start", "end").filter(F.col("end") - F.col("start") >= min_length)


def _breakpoints(tracks: DataFrame, tile: int) -> DataFrame:
    """Distinct positions per chromosome with their ordinal and the next position."""
    pos = tracks.select("chrom", F.explode(F.array("start", "end")).alias("pos"), F.lit(1).cast("long").alias("one"))
    return sweep(pos, ["chrom"], ["one"], tile=tile, one_per_pos=True).select(
        "chrom", F.col("start"), F.col("end"), F.col("one").alias("seg"))


def union_tracks(tracks: DataFrame, tile: int = 1 << 20) -> DataFrame:
    """All tracks cut at the breakpoints of any track: ``chrom, start, end, track, value``.

    Segments are numbered along the chromosome, so an interval is a range of segment numbers: two
    equality joins find the range, and the output is as large as the result itself. Segments where
    a track has no value are absent (zero).
    """
    seg = stage(_breakpoints(tracks, _width(tracks, ["chrom"], tile)))
    first = seg.select("chrom", F.col("start"), F.col("seg").alias("_a"))
    last = seg.select("chrom", F.col("end"), F.col("seg").alias("_b"))
    spans = tracks.join(first, ["chrom", "start"]).join(last, ["chrom", "end"]).select(
        "chrom", "track", "value", F.explode(F.sequence("_a", "_b")).alias("seg"))
    return spans.join(seg, ["chrom", "seg"]).select("chrom", "start", "end", "track", "value")


def average_tracks(tracks: DataFrame, n_tracks: int | None = None, tile: int = 1 << 20) -> DataFrame:
    """Mean of all tracks on their common segments, absent stretches counting as zero.

    One sweep over all tracks at once, however many there are; values are summed as decimals of 15 places
    and 22 digits before the point, so the running sum returns to exactly zero. A value beyond that fails.
    """
    tracks = stage(tracks.select("chrom", "start", "end", "track", "value"))
    n = tracks.agg(F.count_distinct("track")).scalar() if n_tracks is None else F.lit(n_tracks)
    tile = _width(tracks, ["chrom"], tile)
    value = F.col("value").cast("decimal(37,15)")
    seg = sweep(_events(tracks, ["chrom"], value), ["chrom"], ["delta"], tile=tile).filter("delta <> 0")
    return seg.select("chrom", "start", "end", (F.col("delta").cast("double") / n).alias("value"))


def _coded(intervals: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Parts of intervals with a code in place of the name (``chrom, start, end, c``), and codes with names. Parts of one interval do not overlap."""
    parts = intervals.select("interval_id", "chrom", "start", "end").filter(F.col("interval_id").isNotNull()).distinct()
    ids = stage(parts.withColumn("c", F.monotonically_increasing_id() + 1))
    names = ids.select("interval_id", "c")
    if ids.count() > ids.agg(F.count_distinct("interval_id")).first()[0]:  # parts of one interval may overlap each other, which does not make a spot ambiguous
        names = stage(ids.groupBy("interval_id").agg(F.min("c").alias("c")))
        ids = merge_intervals(ids.drop("c").join(names, "interval_id"), ["c", "chrom"], tile=tile)
    return ids, names


def _pieces(ids: DataFrame, tile: int) -> DataFrame:
    """Disjoint pieces of the intervals: ``chrom, start, end, c, far``.

    ``c`` is the code of the only interval that covers the piece, null where there are more. ``far`` is the end of the last piece,
    this one or one before it, that is covered more than once or has another code than this one; null where the piece before has the same ``far``.
    A window sees one tile of positions; the last piece of earlier tiles is carried over.
    """
    edges = ids.select("chrom", "c", F.explode(F.array(
        F.struct(F.col("start").alias("pos"), F.lit(1).cast("long").alias("k")),
        F.struct(F.col("end").alias("pos"), F.lit(-1).cast("long").alias("k")),
    )).alias("_e")).select("chrom", "_e.pos", "_e.k", "c")
    # where exactly one interval covers a piece, the running exclusive-or of codes is that interval's code
    covered = stage(sweep(edges, ["chrom"], ["k"], tile=tile, xors=["c"]).filter("k > 0"))
    at = covered.select("chrom", F.floor(F.col("start") / F.lit(tile)).alias("_tile"), "start", "end", F.when(F.col("k") == 1, F.col("c")).alias("c"))
    inside, order = W.partitionBy("chrom", "_tile").orderBy("start"), W.partitionBy("chrom").orderBy("_tile")
    carried = at.groupBy("chrom", "_tile").agg(F.max("end").alias("_e"), F.max_by("c", "start").alias("_c")).select(
        "chrom", "_tile", F.lag("_e").over(order).alias("_e"), F.lag("_c").over(order).alias("_c"))
    near = at.withColumn("_end", F.lag("end").over(inside)).withColumn("_code", F.lag("c").over(inside)).join(carried, ["chrom", "_tile"])
    code = F.when(F.col("_end").isNull(), F.col("_c")).otherwise(F.col("_code"))
    far = F.when(F.col("c").isNull(), F.col("end")).when(~code.eqNullSafe(F.col("c")), F.coalesce("_end", "_e"))
    return stage(near.select("chrom", "start", "end", "c", far.alias("far")))


def _met(spots: DataFrame, keep: Sequence[str], intervals: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """``keep`` of every spot (with ``chrom, start, end``) with ``state`` and ``c``, the code of the only interval met; and codes with names.

    The intervals are cut into disjoint pieces. Of those, the last one that begins at or before the spot's last base tells all: the spot
    meets none if it begins at or behind that piece's end, more than one if it begins before the piece's ``far``, else that piece's interval. So
    spots and pieces are sorted together once, and a spot costs one row of one shuffle, however many intervals or pieces it meets.

    A window sees one tile of positions, and what earlier tiles end with is carried over. Tiles of more than ``PART_ROWS`` spots are dealt to
    several windows, each of which has all pieces of the tile.
    """
    tile = _width(spots, ["chrom"], tile)
    ids, names = _coded(intervals, tile)
    tile = _width(ids, ["chrom"], tile, beyond=True)  # large tiles are dealt to several windows below
    none, place = F.lit(None).cast("long"), F.floor(F.col("_pos") / F.lit(tile))
    pieces = _pieces(ids, tile).select("chrom", F.col("start").alias("_pos"), F.col("end").alias("_end"), F.col("far").alias("_far"), F.col("c").alias("_c")).withColumn("_tile", place)
    at = spots.withColumn("_pos", F.greatest("end", F.col("start") + 1) - 1).withColumn("_tile", place).select(*dict.fromkeys([*keep, "chrom", "start"]), "_pos", "_tile")
    known = F.col("chrom").isNotNull() & F.col("_pos").isNotNull()
    inner = pieces.withColumn("n", F.lit(0).cast("long")).unionByName(
        at.filter(known).select("chrom", "_tile", F.lit(1).cast("long").alias("n"), *[none.alias(c) for c in ("_pos", "_end", "_far", "_c")]))
    earlier = W.partitionBy("chrom").orderBy("_tile").rowsBetween(W.unboundedPreceding, -1)
    tiles = stage(inner.groupBy("chrom", "_tile").agg(
        F.sum("n").alias("n"), F.max("_end").alias("_end"), F.max("_far").alias("_far"), F.max_by("_c", "_pos").alias("_c")).select(
        "chrom", "_tile", "n", F.max("_end").over(earlier).alias("_end"), F.max("_far").over(earlier).alias("_far"), F.last("_c", True).over(earlier).alias("_c")))
    carried = tiles.filter("n > 0 and _end is not null").select("chrom", (F.col("_tile") * tile - 1).alias("_pos"), "_end", "_far", "_c", "_tile")
    told, parts = pieces.unionByName(carried), F.lit(1).cast("long")
    large = tiles.filter(F.col("n") > PART_ROWS).select("chrom", "_tile", F.ceil(F.col("n") / PART_ROWS).alias("_parts"))
    if not large.isEmpty():
        large, parts = stage(large), F.coalesce("_parts", F.lit(1).cast("long"))
        told, at = told.join(large, ["chrom", "_tile"], "left"), at.join(large, ["chrom", "_tile"], "left")
    told = told.select("chrom", "_tile", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_part"), "_pos", F.lit(0).alias("_asked"), "_end", "_far", "_c")
    # spots without a place meet no piece, so any number of windows will do
    part = F.pmod(F.xxhash64(*keep, "start"), F.when(known, parts).otherwise(F.lit(1 << 12).cast("long")))
    at = at.select(*dict.fromkeys([*keep, "chrom", "start"]), "_tile", part.alias("_part"), "_pos", F.lit(1).alias("_asked"))
    begun = W.partitionBy("chrom", "_tile", "_part").orderBy("_pos", "_asked").rowsBetween(W.unboundedPreceding, 0)
    run = at.unionByName(told, allowMissingColumns=True).select(
        *keep, "start", "_asked", F.max("_end").over(begun).alias("_end"), F.max("_far").over(begun).alias("_far"), F.last("_c", True).over(begun).alias("_c")).filter("_asked = 1")
    met, several = F.coalesce(F.col("start") < F.col("_end"), F.lit(False)), F.coalesce(F.col("start") < F.col("_far"), F.lit(False))
    state = F.when(~met, "no_feature").when(several, "ambiguous").otherwise("assigned")
    return run.select(*keep, state.alias("state"), F.when(met & ~several, F.col("_c")).alias("c")), names


def count_overlaps(
    reads: DataFrame, intervals: DataFrame, keys: Sequence[str] = ("sample_id",), by_start: bool = False,
    tile: int = 1 << 20, by_pair: bool = False,
) -> DataFrame:
    """Reads per interval and key, plus the unassigned ones: ``keys, status, interval_id, n``.

    ``intervals`` is ``interval_id, chrom, start, end``; rows that share an ``interval_id`` are parts of one interval, and a
    row that ends where it starts covers nothing. A read that overlaps more than one interval
    is ambiguous and not assigned (``interval_id`` null with status ``ambiguous``); one without an
    overlap has the status ``no_feature``. ``by_start`` counts by the 5' end only.

    ``by_pair`` counts fragments: the records that share the keys and ``read_id``, on whatever chromosomes, are one. A
    fragment meets what any of its records meets: one interval in all is assigned, more are ambiguous, whether one mate meets
    them or both together.

    Equal reads are summed up before they meet anything; the records of fragments keep their ids and meet intervals one by one.
    """
    keys = list(keys)
    if by_start:
        five = F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start"))
        reads = reads.withColumn("_p", five).withColumn("start", F.col("_p")).withColumn("end", F.col("_p") + 1).drop("_p")
    if by_pair:
        placed = reads.withColumn("start", F.when(F.col("end").isNotNull(), F.col("start")))  # a record without an end meets nothing
        records, names = _met(placed, [*keys, "read_id"], intervals, tile)
        found = records.groupBy(*keys, "read_id").agg(
            F.min("c").alias("c"), ((F.min("c") != F.max("c")) | F.bool_or(F.col("state") == "ambiguous")).alias("several"))
        status = F.when(F.coalesce("several", F.lit(False)), "ambiguous").when(F.col("c").isNotNull(), "assigned").otherwise("no_feature")
        found = found.withColumn("state", status).withColumn("n", F.lit(1).cast("long")).withColumn("c", F.when(F.col("state") == "assigned", F.col("c")))
    else:
        spots = stage(reads.groupBy(*keys, "chrom", "start", "end").agg(F.count(F.lit(1)).alias("n")))
        found, names = _met(spots, [*keys, "n"], intervals, tile)
    counted = found.groupBy(*keys, F.col("state").alias("status"), "c").agg(F.sum("n").alias("n"))
    return counted.join(names, "c", "left").select(*keys, "status", "interval_id", "n")


def frip(counts: DataFrame, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Share of reads in intervals: assigned / (assigned + without a feature). Ambiguous reads are in neither."""
    hit = F.sum(F.when(F.col("status") == "assigned", F.col("n")).otherwise(0))
    total = F.sum(F.when(F.col("status") != "ambiguous", F.col("n")).otherwise(0))
    return counts.groupBy(*keys).agg(hit.alias("assigned"), total.alias("total"), (hit / F.nullif(total, F.lit(0))).alias("frip"))


def mito_read_percent(alignments: DataFrame, mito: str = "chrM") -> DataFrame:
    """100 x mitochondrial reads / mapped reads per sample."""
    mapped = alignments.filter(~has_bits("flag", UNMAPPED))
    return mapped.groupBy("sample_id").agg(
        F.count_if(F.col("chrom") == mito).alias("mito"), F.count(F.lit(1)).alias("mapped"),
        (F.count_if(F.col("chrom") == mito) * 100.0 / F.count(F.lit(1))).alias("percent"))


def alignment_summary(alignments: DataFrame) -> DataFrame:
    """Reads per flag class and sample."""
    def n(bits: int) -> Column:
        return F.count_if(F.col("flag").bitwiseAND(F.lit(bits)) != 0)

    return alignments.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~has_bits("flag", UNMAPPED)).alias("mapped"), n(PAIRED).alias("paired"),
        n(PROPER).alias("proper_pair"), n(SECONDARY).alias("secondary"), n(SUPPLEMENTARY).alias("supplementary"),
        n(DUPLICATE).alias("duplicates"), n(QC_FAIL).alias("qc_fail"))


def reads_per_chromosome(alignments: DataFrame) -> DataFrame:
    return alignments.filter(~has_bits("flag", UNMAPPED)).groupBy("sample_id", "chrom").agg(F.count(F.lit(1)).alias("n"))


def insert_sizes(alignments: DataFrame) -> DataFrame:
    """Histogram of absolute template lengths of the leftmost mates of mapped pairs."""
    pairs = alignments.filter((F.col("tlen") > 0) & has_bits("flag", PAIRED) & ~has_bits("flag", UNMAPPED))
    return pairs.groupBy("sample_id", F.abs("tlen").alias("insert_size")).agg(F.count(F.lit(1)).alias("n"))


def insert_size_metrics(histogram: DataFrame) -> DataFrame:
    """Pairs, mean and median insert size per sample, from the histogram."""
    h = stage(histogram)
    median = exact_quantiles(h, ["sample_id"], "insert_size", {"median": 0.5}, weight="n").drop("n")
    mean = h.groupBy("sample_id").agg(
        F.sum("n").alias("pairs"), (F.sum(F.col("n") * F.col("insert_size")) / F.sum("n")).alias("mean"))
    return mean.join(median, "sample_id")


def mark_duplicate_pairs(alignments: DataFrame) -> DataFrame:
    """Flag both records of every pair but the first (by id) with the same two 5' ends; unmated reads pass unmarked.

    The mates of a pair share ``sample_id, read_id``. Where there are flags, records that are unmapped,
    secondary or supplementary take no part. Where there is a ``cigar``, 5' ends are those before clipping.
    The signature of a pair is built from both ends first; its kept pair is a pre-aggregated minimum.
    """
    part = alignments
    if "flag" in alignments.columns:
        part = alignments.filter(F.col("flag").bitwiseAND(F.lit(UNMAPPED | SECONDARY | SUPPLEMENTARY)) == 0)
    end = F.struct("chrom", five_prime(alignments).alias("five"), "strand")
    pairs = part.groupBy("sample_id", "read_id").agg(F.count(F.lit(1)).alias("_n"), F.min(end).alias("_a"), F.max(end).alias("_b")).filter("_n = 2")
    pairs = stage(pairs.drop("_n"))
    keepers = pairs.groupBy("sample_id", "_a", "_b").agg(F.min("read_id").alias("_first"))
    copies = pairs.join(keepers, ["sample_id", "_a", "_b"]).filter("read_id <> _first").select("sample_id", "read_id", F.lit(True).alias("_copy"))
    takes_part = F.lit(True) if "flag" not in alignments.columns else F.col("flag").bitwiseAND(F.lit(UNMAPPED | SECONDARY | SUPPLEMENTARY)) == 0
    return alignments.join(copies, ["sample_id", "read_id"], "left").withColumn(
        "is_duplicate", F.coalesce(F.col("_copy") & takes_part, F.lit(False))).select(*alignments.columns, "is_duplicate")


def mark_duplicates(alignments: DataFrame) -> DataFrame:
    """Flag every single read but the first (by id) with the same chromosome, 5' end and strand.

    Where there is a ``cigar``, 5' ends are those before clipping.
    The kept read of each signature is a pre-aggregated minimum and is joined back by its unique
    id, so a signature shared by very many copies never gathers in one task.
    """
    signature = ["sample_id", "chrom", "_five", "strand"]
    keepers = alignments.withColumn("_five", five_prime(alignments)).groupBy(*signature).agg(F.min("read_id").alias("read_id"))
    keepers = keepers.select("sample_id", "read_id").distinct().withColumn("_keep", F.lit(True))
    return alignments.join(keepers, ["sample_id", "read_id"], "left").withColumn(
        "is_duplicate", F.col("_keep").isNull()).drop("_keep").select(*alignments.columns, "is_duplicate")


def deduplicate(alignments: DataFrame, paired: bool = False) -> DataFrame:
    marked = mark_duplicate_pairs(alignments) if paired else mark_duplicates(alignments)
    return marked.filter(~F.col("is_duplicate")).drop("is_duplicate")


def window_counts(df: DataFrame, width: int, keys: Sequence[str] = ("sample_id", "chrom")) -> DataFrame:
    """Interval midpoints per fixed window."""
    mid = F.floor((F.col("start") + F.col("end")) / 2 / width)
    return df.groupBy(*keys, mid.alias("win")).agg(F.count(F.lit(1)).alias("n"))


def call_enriched(
    df: DataFrame, sizes: DataFrame, width: int = 150, local: Sequence[int] = (5, 50), q: float = 0.005, min_length: int = 150
) -> DataFrame:
    """Enriched intervals per sample: windows that beat a local Poisson background, merged.

    The background of a window is the largest of the genome mean and the mean over ``local`` windows
    to both sides. A chromosome has a bounded number of windows however many reads fall on it. This
    is its own definition of a peak, not that of any other caller.
    """
    w = stage(window_counts(df, width))
    n_windows = sizes.agg(F.sum(F.ceil(F.col("size") / width))).scalar()
    totals = w.groupBy("sample_id").agg(F.sum("n").alias("_total"))
    seq = W.partitionBy("sample_id", "chrom").orderBy("win")
    means = [F.sum("n").over(seq.rangeBetween(-k, k)) / (2 * k + 1) for k in local]
    t = w.select("*", F.greatest(*means).alias("_local") if len(means) > 1 else means[0].alias("_local"))
    t = t.join(totals, "sample_id").withColumn("lambda", F.greatest(F.col("_total") / n_windows, F.col("_local")))
    t = t.withColumn("p_value", poisson_sf(F.col("n").cast("double"), F.col("lambda"))).drop("_local", "_total")
    t = bh_adjust(t, by=["sample_id"], out="q_value").filter(F.col("q_value") < q)
    spans = t.select("sample_id", "chrom", (F.col("win") * width).alias("start"), ((F.col("win") + 1) * width).alias("end"))
    return merge_intervals(spans, ["sample_id", "chrom"], min_length)


def position_sorted(df: DataFrame) -> DataFrame:
    """Global order by chromosome, start, end, strand: a range shuffle, then a sort inside partitions."""
    cols = [c for c in ("chrom", "start", "end", "strand") if c in df.columns]
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)
