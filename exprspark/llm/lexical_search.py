"""Ranked lexical search turned around: the items' terms are the index, the documents are the stream.

The inverted index over the items' terms (term, items, weights) is broadcast; one pass over the documents keeps each one's
counts of those terms, from which Spark sums the corpus figures (documents, lengths, documents a term); a second pass
streams the counts through the index. A task scores a block of documents against all items at once and keeps per item
a heap of the best ``top``; the tasks' heaps are merged by a window. All scores are 64-bit integers.

Items enter in blocks of at most ``BLOCK_TERMS`` terms, each with its own two passes, so the broadcast is bounded whatever
the number of items. An item that alone has more terms is cut into pieces; its pieces' scores are summed by a shuffle
before the ranking.

Defined results: every row of documents is a document, repeated rows too; a null or empty text has no terms and is never
found; a null doc_id comes after all others among equal scores; items that repeat item_id and text are one item, other
texts under the same item_id are ranked on their own; an item without terms or hits has no rows; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exprspark.session import stage

TOP = 20
#: terms of items in one broadcast index (about 100 bytes each in a task)
BLOCK_TERMS = 500_000
#: scores held at once by a task: documents x items
CELLS = 500_000
#: every byte: A-Z lower-cased, digits, letters and all bytes of other characters kept, the rest a space
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
NO_ID = np.iinfo(np.int64).max


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(TERM_BYTES).split(b" ") if text else []


def _item_batches(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                count = Counter(terms(b.column("text")[at].as_py()))
                count.pop(b"", None)
                words = sorted(count)
                for piece in range(0, len(words), limit):
                    part = words[piece:piece + limit]
                    yield pa.record_batch([
                        pa.array([b.column("item")[at].as_py()], pa.int64()), pa.array([piece // limit], pa.int32()), pa.array([len(words) > limit]),
                        pa.array([part], pa.list_(pa.binary())), pa.array([[count[w] for w in part]], pa.list_(pa.int64())),
                    ], ["item", "piece", "cut", "terms", "times"])

    return run


def _count_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for b in batches:
            n, ids, times = [], [], []
            for x in b.column("text"):
                words = terms(x.as_py())
                known, count = np.unique(np.fromiter((i for i in map(get, words) if i is not None), np.int32), return_counts=True)
                n.append(len(words) - words.count(b""))
                ids.append(known)
                times.append(count)
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (ids, times)]
            yield pa.record_batch([
                b.column("doc_id"), b.column("hash"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[0].astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[1].astype(np.int64))),
            ], ["doc_id", "hash", "n", "ids", "times"])

    return run


class Heaps:
    """The best ``top`` documents of every item: highest score first, then smallest doc_id."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.item, self.doc, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.ones(items, np.int64)  # a score below this can no longer enter

    def push(self, doc: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: one row per document, one column per item."""
        row, item = np.nonzero(scores >= self.least)
        if not row.size:
            return
        self.item = np.concatenate((self.item, item))
        self.doc = np.concatenate((self.doc, doc[row]))
        self.score = np.concatenate((self.score, scores[row, item]))
        order = np.lexsort((self.doc, -self.score, self.item))
        at = self.item[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        nth = np.arange(at.size) - np.repeat(first, np.diff(np.concatenate((first, [at.size]))))
        kept = order[nth < self.top]
        full = order[nth == self.top - 1]
        self.least[self.item[full]] = self.score[full]
        self.item, self.doc, self.score = self.item[kept], self.doc[kept], self.score[kept]


def _score(ids: np.ndarray, parts: np.ndarray, rows: np.ndarray, n_rows: int, index: dict) -> np.ndarray:
    """Documents x items: sums of weight x part over the postings of each document's terms."""
    first, width, n_items = index["first"], index["width"], index["items"]
    deg = width[ids]
    at = np.repeat(first[ids] - np.cumsum(deg) + deg, deg) + np.arange(deg.sum())
    cell = np.repeat(rows, deg) * n_items + index["item"][at]
    add = index["weight"][at] * np.repeat(parts, deg)
    if index["exact"]:  # every sum stays below 2**53, where doubles are exact
        return np.bincount(cell, add, n_rows * n_items).astype(np.int64).reshape(n_rows, n_items)
    out = np.zeros(n_rows * n_items, np.int64)
    np.add.at(out, cell, add)
    return out.reshape(n_rows, n_items)


def _search_batches(shared, top: int | None):
    """Rows (no, doc_id, hash, score): the heaps of a task, without hashes, or all scores if ``top`` is None."""

    def out(item: np.ndarray, doc: np.ndarray, hashes: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([
            pa.array(item.astype(np.int32)), pa.array(doc, pa.int64(), mask=doc == NO_ID), pa.array(hashes), pa.array(score)], ["no", "doc_id", "hash", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        n_items, total, length = index["items"], index["documents"], index["length"]
        heaps = Heaps(n_items, top or 0)
        for b in batches:
            doc, hashes = b.column("doc_id").fill_null(NO_ID).to_numpy(), b.column("hash").to_numpy()
            m = 75 + 25 * b.column("n").to_numpy() * total // length
            ends = b.column("ids").offsets.to_numpy().astype(np.int64)
            ids, times = b.column("ids").values.to_numpy(), b.column("times").values.to_numpy()
            step = max(1, CELLS // n_items)
            work = np.concatenate(([0], np.cumsum(index["width"][ids])))  # postings up to each term
            at = 0
            while at < b.num_rows:
                far = np.searchsorted(work[ends], work[ends[at]] + 2 * CELLS, "right") - 1
                to = int(min(max(far, at + 1), at + step, b.num_rows))
                some = slice(ends[at], ends[to])
                rows = np.repeat(np.arange(to - at), np.diff(ends[at:to + 1]))
                t = times[some]
                scores = _score(ids[some], 1_000_000_000 * t // (1000 * t + 12 * m[at:to][rows]), rows, to - at, index)
                if top:
                    heaps.push(doc[at:to], scores)
                else:
                    row, item = np.nonzero(scores)
                    yield out(item, doc[at:to][row], hashes[at:to][row], scores[row, item])
                at = to
        yield out(heaps.item, heaps.doc, np.zeros(heaps.doc.size, np.int64), heaps.score)

    return run


def _search_block(docs: DataFrame, block: list, top: int | None) -> DataFrame:
    """Rows (item, piece, doc_id, hash, score) for the collected pieces of items of one block."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    term = np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for r in block for t in r["terms"]], np.int64)
    item = np.repeat(np.arange(len(block)), [len(r["terms"]) for r in block])
    times = np.array([x for r in block for x in r["times"]], np.int64)
    counted = docs.mapInArrow(_count_batches(spark.sparkContext.broadcast(vocabulary)), "doc_id long, hash long, n long, ids array<int>, times array<long>")
    counts = stage(counted.filter("n > 0"))
    corpus = counts.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(1)).alias("length")).first()
    held = counts.select(F.explode("ids").alias("term")).groupBy("term").count().collect()  # at most one row a term of the block
    df = np.zeros(len(vocabulary), np.int64)
    df[[r["term"] for r in held]] = [r["count"] for r in held]
    idf = np.array([math.floor(1000 * math.log((2 * corpus["documents"] + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    order = np.argsort(term, kind="stable")
    width = np.bincount(term, minlength=len(vocabulary))
    weight = (idf[term] * times)[order]
    most = np.bincount(item, np.abs(idf[term] * times).astype(float), len(block)).max(initial=0)
    index = {
        "first": np.cumsum(width) - width, "width": width, "item": item[order], "weight": weight, "items": len(block), "exact": most * 1e6 < 2**53,
        "documents": corpus["documents"], "length": corpus["length"],
    }
    found = counts.mapInArrow(_search_batches(spark.sparkContext.broadcast(index), top), "no int, doc_id long, hash long, score long")
    names = spark.createDataFrame([(i, r["item"], r["piece"]) for i, r in enumerate(block)], "no int, item long, piece int")
    return found.join(F.broadcast(names), "no").select("item", "piece", "doc_id", "hash", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0."""
    spark = docs.sparkSession
    streamed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    named = stage(items.select("item_id", "text").dropDuplicates().select("item_id", "text", F.monotonically_increasing_id().alias("item")))
    cut = stage(named.select("item", F.col("text").cast("binary").alias("text")).mapInArrow(
        _item_batches(block_terms), "item long, piece int, cut boolean, terms array<binary>, times array<long>").withColumn("size", F.size("terms").cast("long")))
    # blocks are ranges of a running total of sizes inside 4,096 hash groups, and of the groups' totals
    group = F.pmod(F.xxhash64("item", "piece"), F.lit(4096))
    sized = cut.withColumn("group", group)
    totals = sized.groupBy("group").agg(F.sum("size").alias("total"))
    before = totals.select("group", (F.sum("total").over(Window.orderBy("group")) - F.col("total")).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("group").orderBy("item", "piece"))
    placed = stage(sized.withColumn("upto", inside).join(F.broadcast(before), "group").withColumn(
        "block", F.floor((F.col("before") + F.col("upto") - 1) / block_terms)).drop("group", "before", "upto", "size"))
    whole, parts = [], []
    for b in [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]:
        block = placed.filter(F.col("block") == b).orderBy("item", "piece").collect()
        if own := [r for r in block if not r["cut"]]:
            whole.append(_search_block(streamed, own, top))
        if cuts := [r for r in block if r["cut"]]:
            parts.append(_search_block(streamed, cuts, None))
    every = spark.createDataFrame([], "item long, doc_id long, score long")
    for found in whole:
        every = every.unionByName(found.select("item", "doc_id", "score"))
    if parts:
        pieces = parts[0]
        for found in parts[1:]:
            pieces = pieces.unionByName(found)
        # repeated rows have equal scores in every piece: they are added up as one and then told apart again
        same = pieces.groupBy("item", "piece", "doc_id", "hash").agg(F.max("score").alias("score"), F.count("*").alias("copies"))
        summed = same.groupBy("item", "doc_id", "hash").agg(F.sum("score").alias("score"), F.max("copies").alias("copies"))
        every = every.unionByName(summed.select("item", "doc_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("item", "doc_id", "score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = every.select("item", "doc_id", "score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
