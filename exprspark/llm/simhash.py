"""SimHash near-dedup with covering locality-sensitive hashing.

Every bit position gets a 5-bit code; table ``v`` (1..31) keeps the positions whose code has an odd inner product
with ``v``. Any four positions span at most four dimensions, so some ``v`` is orthogonal to their codes: every pair
within four bits agrees on all kept bits of some table. With codes dealt evenly each table keeps 32 to 34 bits.

Copies collapse first (one row per distinct fingerprint). A bucket is read as a sorted run; inside it a search that
visits each fingerprint once gives a spanning set of the links of at most four bits, never all pairs. A run
of more than ``RUN`` fingerprints is handed to a second covering over the bits that its table dropped: its buckets agree
on 48 bits or so, hence hold at most 2**17 fingerprints by construction.

Defined results: a null or empty text has fingerprint zero and is linked like any other; copies share a fingerprint; a
null doc_id is never a component's id unless all of its documents have none; an empty table gives an empty table; other
columns are ignored by ``near_duplicates`` and kept by ``keep_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.common import same
from exprspark.llm.components import components
from exprspark.session import spread, stage

SHINGLE = 4
RADIUS = 4
SEED = 42
RUN = 4096
TABLES = 2 ** (RADIUS + 1) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering(positions: list[int]) -> list[int]:
    """One mask per table over the given bit positions: any RADIUS positions miss one of the masks."""
    codes = {p: i % TABLES + 1 for i, p in enumerate(positions)}
    return [sum(1 << p for p, c in codes.items() if (c & v).bit_count() & 1) for v in range(1, TABLES + 1)]


MASKS = covering(list(range(64)))
#: second covering of table v: what table v keeps, and a covering of what it drops
SUBMASKS = [[m | s for s in covering([p for p in range(64) if not m >> p & 1])] for m in MASKS]


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the word shingles of a text, unsigned."""
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    if len(ws) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(ws), SEED)
    joined = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total, n, digest = np.zeros(64, np.int64), len(ws) - SHINGLE + 1, xxhash.xxh64_intdigest
    for at in range(0, n, 100_000):
        a, b = starts[at:min(at + 100_000, n)], ends[at + SHINGLE - 1:at + SHINGLE - 1 + min(100_000, n - at)]
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(a.tolist(), b.tolist())], np.uint64)
        total += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(x.as_py()) for x in b.column("text")], np.uint64).view(np.int64)
        yield pa.record_batch([b.column("doc_id"), b.column("text_hash"), pa.array(fps)], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, fp long")


def spanning_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of at most RADIUS bits that join all fingerprints which such links connect. Memory grows with ``fps`` only."""
    left, a, b = np.unique(fps), [], []
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= RADIUS
            if near.any():
                found = left[near]
                a.append(np.full(found.size, at))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _runs(limit: int | None):
    """Reads rows sorted by (v, key, fp); gives links (a, b, v = 0), or for runs above ``limit`` their rows (a = b = fp, v)."""

    def batch(a: np.ndarray, b: np.ndarray, v: int) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(a.size, v, np.int32))], ["a", "b", "v"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> None:
            if size > 1 and held:
                a, b = spanning_links(np.concatenate(held))
                if a.size:
                    found.append((a, b))

        for x in batches:
            v, k = x.column("v").to_numpy(), x.column("key").to_numpy()
            fp = x.column("fp").to_numpy().view(np.uint64)
            if not v.size:
                continue
            cuts = np.flatnonzero((v[1:] != v[:-1]) | (k[1:] != k[:-1])) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [v.size]))
            # runs of one row inside the batch link nothing
            wanted = np.flatnonzero((ends - starts > 1) | (np.arange(starts.size) == 0) | (np.arange(starts.size) == starts.size - 1))
            for i in wanted:
                s, e = starts[i], ends[i]
                if key != (v[s], k[s]):
                    close()
                    key, held, size = (v[s], k[s]), [], 0
                held.append(fp[s:e])
                size += int(e - s)
                if limit and size > limit:  # hand on what is held; later parts of this run follow the same way
                    whole = np.concatenate(held)
                    yield batch(whole, whole, int(v[s]))
                    held = []
            if found:
                yield batch(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]), 0)
                found.clear()
        close()
        if found:
            yield batch(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]), 0)

    return read


def _in_runs(rows: DataFrame, limit: int | None) -> DataFrame:
    return spread(rows, "v", "key").sortWithinPartitions("v", "key", "fp").mapInArrow(_runs(limit), "a long, b long, v int")


def links(distinct: DataFrame, run: int = RUN) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fp`` exactly as all links of at most RADIUS bits do."""
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for v, m in enumerate(MASKS, 1)])
    first = stage(_in_runs(distinct.select("fp", F.explode(tables).alias("t")).select("t.v", "t.key", "fp"), run))
    flat = F.lit([_signed(s) for sub in SUBMASKS for s in sub])
    again = F.transform(F.sequence(F.lit(1), F.lit(TABLES)), lambda w: F.struct(
        (F.col("v") * 64 + w).alias("v"), F.col("a").bitwiseAND(F.get(flat, (F.col("v") - 1) * TABLES + w - 1)).alias("key")))
    large = first.filter("v > 0").select("a", F.explode(again).alias("t")).select("t.v", "t.key", F.col("a").alias("fp"))
    return first.filter("v = 0").select("a", "b").unionByName(_in_runs(large, None).select("a", "b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of every row."""
    rows = stage(fingerprints(docs))
    heads = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = components(stage(links(heads.select("fp"))))
    rooted = stage(heads.join(joined, heads["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")))  # written: see components
    named = stage(rooted.join(least, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_documents(docs: DataFrame) -> DataFrame:
    """One document of each group with all its columns: the first by (doc_id, text hash), a null doc_id last; rows that repeat it go."""
    groups = near_duplicates(docs)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    # a component without any doc_id is known by its fingerprints' root only through component_id = null: those stay apart by fingerprint
    key = F.when(F.col("component_id").isNull(), F.col("fp"))
    first = groups.groupBy("component_id", key.alias("fp_key")).agg(F.min(order).alias("first")).select("first.doc_id", "first.text_hash")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    kept = rows.join(first, rows["_id"].eqNullSafe(first["doc_id"]) & rows["_hash"].eqNullSafe(first["text_hash"]), "left_semi")
    return kept.dropDuplicates(["_id", "_hash"]).select("_row.*")
