"""Sequencing reads: trimming, quality measures, allele counts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.operators.intervals import cigar_blocks

# The common prefix of the sequencing adapters, and the transposase adapter.
ADAPTER = "AGATCGGAAGAGC"
TRANSPOSASE_ADAPTER = "CTGTCTCTTATACACATCT"


def _gapped_places(texts: list[bytes], keep: np.ndarray, adapter: str, min_overlap: int, errors: float) -> np.ndarray:
    """Where the adapter begins in the kept part of every read, with insertions and deletions; ``keep`` where it does not.

    The cost of a place is the least number of edits between the adapter and what follows the place, or, where the read ends
    inside the adapter, between a prefix of ``n`` bases and the rest of the read, plus what ``n`` bases allow less than the whole
    adapter does. A place fits at a cost of at most ``errors`` times the adapter's length. Of the first place that fits and
    as many places behind it as errors are allowed, the one of least cost is taken, the first of equal ones.

    Reads and adapter are walked from their ends. State i of a read is bit i: i bases of the reversed adapter are done; there is
    one word of bits per number of errors, and one step of a whole block is a few operations on arrays of words.
    """
    m = len(adapter)
    if m > 62:
        raise ValueError("an adapter of more than 62 bases does not fit a word")
    limit = int(m * errors + 1e-9)
    word = np.uint64
    mask = np.zeros(256, word)
    for i, base in enumerate(adapter[::-1].encode()):
        mask[base] |= word(1 << (i + 1))
    # before the first base: i of the adapter's last bases hang over the read's end, or are left out at a cost
    start = [limit + 1] * (m + 1)
    for i in range(m + 1):
        hang = limit - int((m - i) * errors + 1e-9) if m - i >= min_overlap or not i else limit + 1
        start[i] = min(hang if i else 0, start[i - 1] + 1 if i else 0)
    width = int(keep.max(initial=0))
    reads = np.zeros((len(texts), width), np.uint8)
    for row, (text, n) in enumerate(zip(texts, keep.tolist())):
        reads[row, :n] = np.frombuffer(text, np.uint8)[:n][::-1]
    state = [np.full(len(texts), sum(1 << i for i in range(m + 1) if start[i] <= k), word) for k in range(limit + 1)]
    done, one = word(1 << m), word(1)
    cost = np.full((len(texts), width + 1), limit + 1, np.int64)  # by number of bases from the read's end
    for j in range(width):
        fits = mask[reads[:, j]]
        before = None
        for k in range(limit + 1):
            old = state[k]
            new = (old << one) & fits | one
            if k:
                new |= before | before << one | state[k - 1] << one  # extra base in the read, other base, missing base
            before, state[k] = old, new
            hit = (new & done != 0) & (cost[:, j + 1] > k)
            cost[hit, j + 1] = k
    cost[np.arange(width + 1) > keep[:, None]] = limit + 1
    place = keep[:, None] - np.arange(width + 1)
    first = np.where(cost <= limit, place, width + 1).min(axis=1, initial=width + 1)
    near = (cost <= limit) & (place >= first[:, None]) & (place <= first[:, None] + limit)
    best = np.where(near, cost * (width + 2) + place, (limit + 2) * (width + 2)).min(axis=1, initial=(limit + 2) * (width + 2))
    return np.where(first <= width, best % (width + 2), keep)


def _cuts(seq: pa.Array, qual: pa.Array | None, adapter: str, min_overlap: int, errors: float, quality: int | None, gaps: bool = False, block: int = 4096) -> np.ndarray:
    """Bases to keep of every read: before the first place where the adapter fits, after quality trimming.

    All reads of a block are one padded matrix, compared with the adapter one base at a time.
    """
    out = np.zeros(len(seq), np.int64)
    want = np.frombuffer(adapter.encode(), np.uint8)
    for at in range(0, len(seq), block):
        texts = [(x or "").encode() for x in seq[at:at + block].to_pylist()]
        size = np.array([len(x) for x in texts])
        width = int(size.max(initial=0))
        keep = size.copy()
        if quality is not None and qual is not None and width:
            scores = np.frombuffer(b"".join((x or "").encode()[:width].ljust(width, b"~") for x in qual[at:at + block].to_pylist()), np.uint8).reshape(-1, width).astype(np.int64) - 33
            scores = np.where(np.arange(width) < size[:, None], quality - scores, 0)
            tail = np.cumsum(scores[:, ::-1], axis=1)[:, ::-1]  # of each suffix; the worst suffix goes
            # scores below zero stop the run, as everything before the first good stretch stays
            blocked = np.maximum.accumulate((tail < 0)[:, ::-1], axis=1)[:, ::-1]
            tail = np.where(blocked, -1, tail)
            best = tail.max(axis=1, initial=0)
            first = np.where(tail == best[:, None], np.arange(width), width).min(axis=1, initial=width)
            keep = np.where(best > 0, np.minimum(keep, first), keep)
        if gaps:
            out[at:at + block] = _gapped_places(texts, keep, adapter, min_overlap, errors)
            continue
        bases = np.frombuffer(b"".join(x.ljust(width + want.size, b"\0") for x in texts), np.uint8).reshape(len(texts), -1)
        wrong = np.zeros((len(texts), width), np.int32)
        for j, base in enumerate(want.tolist()):
            wrong += (bases[:, j:j + width] != base) & (np.arange(j, j + width) < keep[:, None])
        overlap = np.minimum(keep[:, None] - np.arange(width), want.size)
        fits = (overlap >= min_overlap) & (wrong <= np.floor(overlap * errors + 1e-9))
        place = np.where(fits, np.arange(width), width).min(axis=1, initial=width)
        out[at:at + block] = np.minimum(keep, place)
    return out


def trim_reads(
    reads: DataFrame, adapter: str = ADAPTER, min_overlap: int = 3, min_length: int = 31,
    max_n: float = 0.1, paired: bool = False, errors: float = 0.0, quality: int | None = None, gaps: bool = False,
) -> DataFrame:
    """Cut the adapter (whole, or a prefix of it at the 3' end), then drop short and N-rich reads.

    ``errors`` is the share of the overlap that may differ, and the first place that fits is cut. Differences are substitutions,
    with ``gaps`` also insertions and deletions (see :func:`_gapped_places`). ``quality`` first cuts the 3' end whose scores stay furthest below that limit in sum. Exact
    matches without quality trimming are one regular expression, the rest is compared in Arrow batches. With ``paired``
    both mates must pass.
    """
    if errors > 0 or quality is not None:
        has_quality = "qual" in reads.columns

        @F.arrow_udf("int")
        def keep(seq: pa.Array, qual: pa.Array) -> pa.Array:
            return pa.array(_cuts(seq, qual if has_quality else None, adapter, min_overlap, errors, quality, gaps), pa.int32())

        t = reads.withColumn("_keep", keep("seq", F.col("qual") if has_quality else F.col("seq")))
        t = t.withColumn("seq", F.substring("seq", F.lit(1), F.col("_keep")))
        if has_quality:
            t = t.withColumn("qual", F.substring("qual", F.lit(1), F.col("_keep")))
        return _passing(t.drop("_keep"), reads.columns, min_length, max_n, paired)
    tails = "|".join(re.escape(adapter[:n]) for n in range(len(adapter) - 1, min_overlap - 1, -1))
    pattern = f"(?s)^(.*?)(?:{re.escape(adapter)}.*{'|' + tails if tails else ''})?$"
    # A one-element generator computes the cut once per row; filters are not pushed below it and so
    # do not repeat the expression.
    cut = F.explode(F.array(F.regexp_extract("seq", pattern, 1)))
    t = reads.select(*[c for c in reads.columns if c != "seq"], cut.alias("seq"))
    if "qual" in reads.columns:
        t = t.withColumn("qual", F.substring("qual", F.lit(1), F.length("seq")))
    return _passing(t, reads.columns, min_length, max_n, paired)


def _passing(t: DataFrame, columns: list[str], min_length: int, max_n: float, paired: bool) -> DataFrame:
    n_bases = F.length("seq") - F.length(F.translate("seq", "N", ""))
    ok = (F.length("seq") >= min_length) & (n_bases <= max_n * F.length("seq"))
    t = t.withColumn("_ok", ok)
    if paired:
        both = t.groupBy("read_id").agg(F.bool_and("_ok").alias("_both")).filter("_both").select("read_id")
        return t.drop("_ok").join(both, "read_id", "left_semi").select(*columns)
    return t.filter("_ok").select(*columns)


def base_quality(reads: DataFrame) -> DataFrame:
    """Per sample and position: base counts and the sum of qualities.

    A task counts whole Arrow batches with numpy, so bases are never rows; only one short partial
    table per batch reaches the shuffle.
    """
    schema = "sample_id string, pos int, a long, c long, g long, t long, n long, bases long, qual_sum long"

    def count(batches):
        for b in batches:
            if not b.num_rows:
                continue
            names = b.column("sample_id").dictionary_encode()
            codes = names.indices.to_numpy()
            for i, sample in enumerate(names.dictionary.to_pylist()):
                rows = b.filter(pa.array(codes == i))
                seq, qual = (rows.column(c).cast(pa.large_string()) for c in ("seq", "qual"))
                parts = []
                for col in (seq, qual):
                    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
                    raw = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)[off[0] : off[-1]]
                    pos = np.arange(len(raw)) - np.repeat(off[:-1] - off[0], np.diff(off))
                    parts.append((raw, pos))
                (bases, pos), (quals, qpos) = parts
                if not len(pos):
                    continue
                width = int(pos.max()) + 1
                counts = {x: np.bincount(pos[bases == ord(x)], minlength=width) for x in "ACGTN"}
                total = np.bincount(pos, minlength=width)
                score = np.bincount(qpos, weights=quals.astype(float) - 33, minlength=width)[:width]
                yield pa.RecordBatch.from_arrays([
                    pa.array([sample] * width), pa.array(np.arange(1, width + 1, dtype=np.int32)),
                    *[pa.array(counts[x].astype(np.int64)) for x in "ACGTN"], pa.array(total.astype(np.int64)),
                    pa.array(score.astype(np.int64)),
                ], names=["sample_id", "pos", "a", "c", "g", "t", "n", "bases", "qual_sum"])

    sums = [F.sum(c).alias(c) for c in ("a", "c", "g", "t", "n", "bases", "qual_sum")]
    return reads.select("sample_id", "seq", "qual").mapInArrow(count, schema).groupBy("sample_id", "pos").agg(*sums)


def position_summary(base: DataFrame) -> DataFrame:
    """Mean quality and base shares per sample and position."""
    share = [(F.col(x) / F.col("bases")).alias(f"share_{x}") for x in "acgtn"]
    return base.select("sample_id", "pos", "bases", (F.col("qual_sum") / F.col("bases")).alias("mean_quality"), *share)


def read_summary(reads: DataFrame) -> DataFrame:
    """Per sample: reads, mean length, GC percent, and the share of reads that repeat another one.

    Equal sequences are counted before the sample totals.
    """
    seq = F.col("seq")
    gc = F.length(seq) - F.length(F.translate(seq, "GC", ""))
    g = reads.groupBy("sample_id", "seq").agg(F.count(F.lit(1)).alias("k"))
    return g.groupBy("sample_id").agg(
        F.sum("k").alias("reads"), (F.sum(F.col("k") * F.length(seq)) / F.sum("k")).alias("mean_length"),
        F.try_divide(F.sum(F.col("k") * gc) * 100.0, F.sum(F.col("k") * F.length(seq))).alias("gc_percent"),
        ((F.sum("k") - F.count(F.lit(1))) * 100.0 / F.sum("k")).alias("duplicate_percent"))


def length_histogram(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample_id", F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def allele_fractions(
    alignments: DataFrame, min_coverage: int = 20, min_minor: int = 4, min_fraction: float = 0.1
) -> DataFrame:
    """Base counts per position and the share of the second base; ``alignments`` is ``chrom, start, seq[, cigar]``.

    With a ``cigar``, bases are placed by its aligned stretches: clipped and inserted bases have no place, deletions and
    skips move what follows; a record whose ``cigar`` is null is left out. Without one the whole read is aligned.
    Kept are positions with enough coverage, minor bases and minor share. Equal alignments are
    counted once with a weight before their bases become rows.
    """
    if "cigar" in alignments.columns:
        copies = alignments.groupBy("chrom", "start", "cigar", "seq").agg(F.count(F.lit(1)).alias("w"))
        parts = copies.select("chrom", "seq", "w", F.explode(cigar_blocks(F.col("cigar"), F.col("start"))).alias("_b"))
        copies = parts.select("chrom", F.col("_b.ref").alias("start"), F.substring("seq", F.col("_b.at"), F.col("_b.n")).alias("seq"), "w")
    else:
        copies = alignments.groupBy("chrom", "start", "seq").agg(F.count(F.lit(1)).alias("w"))
    bases = copies.select("chrom", "start", "w", F.posexplode(F.split("seq", "")).alias("o", "base"))
    by_base = bases.groupBy("chrom", (F.col("start") + F.col("o")).alias("pos")).agg(
        *[F.sum(F.when(F.col("base") == x, F.col("w")).otherwise(0)).alias(x.lower()) for x in "ACGT"])
    ranked = F.sort_array(F.array("a", "c", "g", "t"), asc=False)
    t = by_base.withColumn("coverage", F.col("a") + F.col("c") + F.col("g") + F.col("t")).withColumn("minor", ranked[1])
    t = t.withColumn("fraction", F.try_divide("minor", "coverage"))
    return t.filter(
        (F.col("coverage") >= min_coverage) & (F.col("minor") >= min_minor) & (F.col("fraction") >= min_fraction))
