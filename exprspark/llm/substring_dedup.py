"""Substring dedup of 50-word windows by super-k-mer partitioning.

The minimiser of a window is the least 8-gram hash in it, leftmost if tied: it depends on the window's words alone. A
super-k-mer is a run of consecutive windows (43 at most) with their minimiser at the same place. First only its hashes
travel: the minimiser, a 128-bit digest of its words, the document and the place. A minimiser found in one document
only cannot hide a shared window; equal super-k-mers collapse to the first document that has them, in which copies
are settled. What is left, different super-k-mers that share a minimiser, travels as one packed string each to the
minimiser's bucket, where its windows are sorted and equal ones compared word by word.

Hot minimisers: a bucket of more than ``BUCKET`` different super-k-mers is dealt over several by digest; their windows then
meet once more by 128-bit window digest, with minima taken per task before that shuffle. The result does not depend on it.

Defined results: a null text has no words; a null doc_id counts as the smallest; rows that repeat a doc_id never remove
words from each other, and rows that repeat doc_id and text get the same result; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.session import spread, stage

WIDTH = 50
GRAM = 8
BUCKET = 8192  # some megabytes of packed strings, under 100 MB of windows while they are sorted
#: 8-grams in a window, and so windows in a super-k-mer at most
PLACES = WIDTH - GRAM + 1
#: words of one piece of a very long text that are numbered together; places take the low bits of an order key
PIECE, PLACE_BITS = 1 << 22, 24
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIXES = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
SPAN = "h long, d1 long, d2 long, id long, text_hash long, start int, n int"


def _order(word_hashes: np.ndarray) -> np.ndarray:
    """A mixed hash of the GRAM words from each place on."""
    n = word_hashes.size - GRAM + 1
    out = np.zeros(n, np.uint64)
    for j in range(GRAM):
        out = out * _STEP + word_hashes[j:j + n]
    out = (out ^ (out >> np.uint64(30))) * _MIXES[0]
    out = (out ^ (out >> np.uint64(27))) * _MIXES[1]
    return out ^ (out >> np.uint64(31))


def _least_places(order: np.ndarray) -> np.ndarray:
    """For each window the place of its least hash, leftmost if tied."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (order & ~low) | np.arange(order.size, dtype=np.uint64)
    reach = 1
    while reach < PLACES:
        step = min(reach, PLACES - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return (least & low).astype(np.int64)


def super_kmers(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(minimiser, first window, number of windows) of the super-k-mers of a text, piece by piece."""
    for at in range(0, max(len(words) - WIDTH + 1, 0), PIECE):
        part = words[at:at + PIECE + WIDTH - 1]
        order = _order(np.fromiter(map(xxhash.xxh64_intdigest, part), np.uint64, len(part)))
        place = _least_places(order)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        yield order[place[starts]], starts + at, np.diff(np.append(starts, place.size))


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, digests, digest = [], [], xxhash.xxh3_128_digest
        for id_, text_hash, text in zip(b.column("id").to_pylist(), b.column("text_hash").to_pylist(), b.column("text")):
            words = (text.as_py() or "").encode().split()
            if len(words) < WIDTH:
                continue
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.append(0, ends[:-1] + 1)
            for h, start, n in super_kmers(words):
                digests += [digest(joined[x:y]) for x, y in zip(begins[start].tolist(), ends[start + n + WIDTH - 2].tolist())]
                out.append((h.view(np.int64), np.full(h.size, id_), np.full(h.size, text_hash), start.astype(np.int32), n.astype(np.int32)))
        if out:
            h, id_, text_hash, start, n = (np.concatenate(x) for x in zip(*out))
            d = _pairs(digests)
            yield pa.record_batch([pa.array(x) for x in (h, d[:, 0].copy(), d[:, 1].copy(), id_, text_hash, start, n)], ["h", "d1", "d2", "id", "text_hash", "start", "n"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed strings of the super-k-mers that are asked for, document by document."""
    for b in batches:
        for i in range(b.num_rows):
            words, rows = (b.column("text")[i].as_py() or "").encode().split(), b.column("asked")[i].as_py()
            packed = [b" ".join(words[x["start"]:x["start"] + x["n"] + WIDTH - 1]) for x in rows]
            yield pa.record_batch([
                pa.array([x["h"] for x in rows], pa.int64()), pa.array([x["salt"] for x in rows], pa.int32()), pa.array([x["split"] for x in rows], pa.bool_()),
                pa.array([x["d1"] for x in rows], pa.int64()), pa.array([x["d2"] for x in rows], pa.int64()),
                pa.array([b.column("id")[i].as_py()] * len(rows), pa.int64()), pa.array(packed, pa.binary()),
            ], ["h", "salt", "split", "d1", "d2", "id", "packed"])


def _windows(packed: bytes) -> list[bytes]:
    at = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    begins, ends = np.append(0, at + 1), np.append(at, len(packed))
    return [packed[x:y] for x, y in zip(begins[:begins.size - WIDTH + 1].tolist(), ends[WIDTH - 1:].tolist())]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts each bucket's windows. Whole buckets give masks (j = -1) of windows that a smaller id has, dealt ones their windows."""
    names = ["h", "d1", "d2", "mask", "j", "w1", "w2", "id"]
    types = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 3

    def bucket(rows: list[tuple]) -> list[tuple]:
        if rows[0][2]:  # one of several parts of a hot bucket: pass on the windows' digests
            out = []
            for h, _, _, d1, d2, id_, packed in rows:
                w = _pairs([xxhash.xxh3_128_digest(x) for x in _windows(packed)])
                out += [(h, d1, d2, 0, j, int(x), int(y), id_) for j, (x, y) in enumerate(w)]
            return out
        masks = [0] * len(rows)
        seen, least = None, 0
        for w, id_, i, j in sorted((w, r[5], i, j) for i, r in enumerate(rows) for j, w in enumerate(_windows(r[6]))):
            if w != seen:
                seen, least = w, id_
            elif least < id_:
                masks[i] |= 1 << j
        return [(r[0], r[3], r[4], m, -1, 0, 0, r[5]) for r, m in zip(rows, masks) if m]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    key, held, out = None, [], []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("h", "salt", "split", "d1", "d2", "id", "packed"))):
            if row[:2] != key:
                if len(held) > 1 or held and held[0][2]:
                    out += bucket(held)
                key, held = row[:2], []
                if len(out) > 20_000:
                    yield batch(out)
                    out = []
            held.append(row)
    if len(held) > 1 or held and held[0][2]:
        out += bucket(held)
    if out:
        yield batch(out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the covered words of each document."""
    for b in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(b.column("text"), b.column("spans")):
            words = (text.as_py() or "").encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for x in spans.as_py() or ():
                if x["mask"] is None:
                    gone[x["start"]] += 1
                    gone[x["start"] + x["n"] + WIDTH - 1] -= 1
                else:
                    for j in range(x["n"]):
                        if x["mask"] >> j & 1:
                            gone[x["start"] + j] += 1
                            gone[x["start"] + j + WIDTH] -= 1
            stay = (np.cumsum(gone[:-1]) == 0).tolist()
            rest = [w for w, s in zip(words, stay) if s] if spans.is_valid else words
            n_words.append(len(words))
            n_removed.append(len(words) - len(rest))
            kept.append(b" ".join(rest).decode())
        yield pa.record_batch([
            b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string()),
        ], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def _removed_spans(docs: DataFrame, bucket: int) -> DataFrame:
    """(id, text_hash, spans): the windows to remove; a null mask stands for all ``n`` from ``start`` on."""
    every = stage(docs.mapInArrow(_spans, SPAN))
    # written first: a join of two tables as they are lets Spark split a hot minimiser, one that holds an aggregate does not
    shared = stage(every.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("h"))
    found = stage(every.join(shared, "h", "left_semi"))
    word = ["h", "d1", "d2"]
    first = stage(found.groupBy(*word).agg(F.min(F.struct("id", "text_hash", "start", "n")).alias("c")).select(*word, "c.*"))
    several = stage(first.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1"))
    parts = F.ceil(F.col("k") / bucket).cast("long")
    asked = first.join(several, "h").select("id", "text_hash", F.struct(
        "h", F.pmod("d1", parts).cast("int").alias("salt"), (parts > 1).alias("split"), "d1", "d2", "start", "n").alias("x"))
    asked = asked.groupBy("id", "text_hash").agg(F.collect_list("x").alias("asked"))
    packed = docs.join(asked, ["id", "text_hash"]).mapInArrow(
        _pack, "h long, salt int, split boolean, d1 long, d2 long, id long, packed binary")
    sorted_ = spread(packed, "h", "salt").sortWithinPartitions("h", "salt")
    counted = stage(sorted_.mapInArrow(_count, "h long, d1 long, d2 long, mask long, j int, w1 long, w2 long, id long"))
    dealt = counted.filter("j >= 0")
    least = stage(dealt.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("last")).filter("least < last").drop("last"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("j"))
    merged = (dealt.join(least, ["w1", "w2"]).filter("id > least").select(*word, bit.alias("bit")).groupBy(*word).agg(F.bit_or("bit").alias("mask")))
    masks = counted.filter("j < 0").select(*word, "mask").distinct().unionByName(merged)
    heads = stage(first.select(*word, F.col("id").alias("first_id")).join(masks, word, "left"))
    spans = found.join(heads, word).filter("id > first_id OR mask IS NOT NULL")
    whole = F.when(F.col("id") > F.col("first_id"), F.lit(None)).otherwise(F.col("mask"))
    return spans.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n", whole.alias("mask"))).alias("spans"))


def remove_repeats(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) of every row: words covered by a window that starts in a document with a smaller id go."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64("text").alias("text_hash"), "text")
    spans = stage(_removed_spans(keyed.drop("doc_id"), bucket))
    joined = keyed.join(spans, ["id", "text_hash"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
