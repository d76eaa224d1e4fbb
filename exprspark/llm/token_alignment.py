"""Alignment of two tokenizers over the same bytes, by products of sparse matrices in hand-built CSR.

Both token sequences of a text spell the same bytes. With the token-byte incidence matrices A and B, the row products
A·Bᵀ (Gustavson: every row of A adds up the rows of Bᵀ that its entries name) give the overlap links and their shared
bytes. Bytes at which both sequences end a token cut them into groups; with the id-group matrices G and H the row
products G·Hᵀ give the shared-group links of every document, added up by id pair. So a group of many equal tokens counts
as products of a few numbers, and its links are never written out one by one.

The first pass writes one row per document with its numbers and its distinct pairs. Spark sums the documents that hold a
pair. Pairs in at least 1/``HEAD`` of all are no more than ``HEAD``: they are broadcast; the others are joined to
the documents that hold them by a shuffle.

Defined results: every row of documents is a document, repeated rows and null doc_ids too; a null or empty text, or one
whose tokens do not spell it, has no tokens; the special tokens' strings are plain text; a very long text is worked through
in segments of about ``SEGMENT`` tokens that end with a group; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.bpe import byte_of_char
from exprspark.session import stage

#: the byte-level word pattern of this kind of tokenizer (fixed value)
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: white space of this length is more than the fast encoder's stack holds; such texts go to the other library
LONG_SPACE = regex.compile(r"\s{2000}")
#: most pairs in the broadcast table (17 bytes each)
HEAD = 1 << 18
#: tokens that a task aligns at a time
SEGMENT = 200_000
#: entries of a product that are expanded at a time
EXPANDED = 1_000_000
#: an id pair is one number: first id << SHIFT | second id
SHIFT = 24


@dataclass
class Csr:
    """Rows of (column, value): those of row i are ``starts[i]:starts[i + 1]``."""

    starts: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    n_cols: int

    @staticmethod
    def of(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, vals: np.ndarray | None = None) -> Csr:
        """Sums the values (1 if none are given) of equal positions."""
        key = rows * n_cols + cols
        order = None if (key[1:] >= key[:-1]).all() else np.argsort(key, kind="stable")
        key = key if order is None else key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if key.size else np.zeros(0, np.int64)
        if vals is None:
            summed = np.diff(np.concatenate((first, [key.size])))
        else:
            summed = np.add.reduceat(vals if order is None else vals[order], first) if key.size else vals
        row, col = np.divmod(key[first], n_cols)
        return Csr(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n_rows)))), col, summed, n_cols)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.starts.size - 1), np.diff(self.starts))

    def times(self, other: Csr) -> Iterator[tuple[int, Csr]]:
        """The product with ``other`` as (first row, block of rows), blocks cut by how many entries they expand to."""
        width = np.diff(other.starts)[self.cols]
        work = np.concatenate(([0], np.cumsum(width)))[self.starts]
        at, n = 0, self.starts.size - 1
        while at < n:
            to = min(n, max(at + 1, int(np.searchsorted(work, work[at] + EXPANDED, "right")) - 1))
            some = slice(self.starts[at], self.starts[to])
            w = width[some]
            entry = np.repeat(other.starts[self.cols[some]] - np.cumsum(w) + w, w) + np.arange(w.sum())
            row = np.repeat(np.repeat(np.arange(to - at), np.diff(self.starts[at:to + 1])), w)
            yield at, Csr.of(row, other.cols[entry], to - at, other.n_cols, np.repeat(self.vals[some], w) * other.vals[entry])
            at = to


def incidence(lengths: np.ndarray) -> Csr:
    """The token-byte matrix of tokens of these lengths laid end to end."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if ends.size else 0
    return Csr(np.concatenate(([0], ends)), np.arange(n), np.ones(n, np.int64), n)


def by_byte(lengths: np.ndarray) -> Csr:
    """The same matrix turned around: every byte has one token."""
    n = int(lengths.sum())
    return Csr(np.arange(n + 1), np.repeat(np.arange(lengths.size), lengths), np.ones(n, np.int64), lengths.size)


def overlaps(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, bytes both cover) of every pair of tokens that share a byte."""
    parts = [(at + block.rows(), block.cols, block.vals) for at, block in incidence(len_a).times(by_byte(len_b))]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3


def groups(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B: bytes at which both sequences end a token end a group."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    return np.searchsorted(common, end_a), np.searchsorted(common, end_b)


def group_links(owner: np.ndarray, ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray):
    """(owner, pair, links): how often the ids of each pair share a group in each owner; ``owner`` names every group's document."""
    n, wide = owner.size, 1 << SHIFT
    # one row per (owner, id of A); the columns are groups
    keys, row = np.unique(owner[group_a] * wide + ids_a, return_inverse=True)
    left = Csr.of(row, group_a, keys.size, n)
    right = Csr.of(group_b, ids_b, n, wide)
    parts = []
    for at, block in left.times(right):
        key = keys[at + block.rows()]
        parts.append((key >> SHIFT, (key & (wide - 1)) << SHIFT | block.cols, block.vals))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3


def _digit_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..n-1 in rows of eight bytes, zero behind them, and their number."""
    text = np.arange(n).astype("S8")
    return text.view(np.uint8).reshape(n, 8)[:, :len(str(n)) + 1].copy(), np.char.str_len(text).astype(np.int64)


def group_text(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, digits) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``a1,a2|b1;a3|b2,b3;`` over all groups, and where each group's part ends (its ``;`` included)."""
    table, size = digits
    n_groups = int(group_a[-1]) + 1
    upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=n_groups)) for g in (group_a, group_b))
    # a group's tokens of A stand behind all tokens of earlier groups, those of B behind its own of A as well
    place_a = np.arange(ids_a.size) + np.concatenate(([0], upto_b))[group_a]
    place_b = np.arange(ids_b.size) + upto_a[group_b]
    rows = np.empty((ids_a.size + ids_b.size, table.shape[1]), np.uint8)
    rows[place_a], rows[place_b] = table[ids_a], table[ids_b]
    width = np.empty(len(rows), np.int64)
    width[place_a], width[place_b] = size[ids_a] + 1, size[ids_b] + 1
    last = upto_a + upto_b
    mark = np.full(len(rows), ord(","), np.uint8)
    mark[place_a[upto_a - 1]], mark[last - 1] = ord("|"), ord(";")
    rows[np.arange(len(rows)), width - 1] = mark
    flat = rows.ravel()
    return flat[flat != 0], np.cumsum(width)[last - 1]


class Encoders:
    """Both tokenizers with their tokens' bytes."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken

        with open(byte_path, encoding="utf-8") as f:
            spec = json.load(f)
        own = {x["content"] for x in spec["added_tokens"]}
        byte = byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in own}
        self.byte_path, self.other = byte_path, None
        self.first = tiktoken.Encoding("first", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_a = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for b, i in ranks.items():
            self.bytes_a[i] = b
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.spelled_b = np.frombuffer(b"".join(self.bytes_b), np.uint8), np.cumsum(self.size_b) - self.size_b
        self.digits = _digit_table(max(len(self.bytes_a), len(self.bytes_b)))

    def _first(self, text: str) -> list[int]:
        if not LONG_SPACE.search(text):
            return self.first.encode_ordinary(text)
        if self.other is None:
            from tokenizers import Tokenizer

            self.other = Tokenizer.from_file(self.byte_path)
            self.other.encode_special_tokens = True
        return self.other.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both, empty if either does not spell a space and the text."""
        if text:
            whole = np.frombuffer((" " + text).encode(), np.uint8)
            a, b = np.array(self._first(" " + text), np.int64), np.array(self.second.encode(text), np.int64)
            # the first tokenizer works on bytes and cannot change them, only lose some; the second may replace characters
            if self.size_a[a].sum() == whole.size and self._spells(b, whole):
                return a, b
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _spells(self, b: np.ndarray, whole: np.ndarray) -> bool:
        size = self.size_b[b]
        if size.sum() != whole.size:
            return False
        text, first = self.spelled_b
        return bool((text[np.repeat(first[b] - np.cumsum(size) + size, size) + np.arange(whole.size)] == whole).all())


class _Document:
    """What is summed up over the segments of one text."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.n_a, self.n_b, self.n_groups, self.n_overlaps, self.n_links = a.size, b.size, 0, 0, 0
        self.text, self.held, self.pairs, self.links = hashlib.sha256(), b"", [], []

    def digest(self) -> str:
        """The group text ends without its last ``;``, which is held back until more follows."""
        return self.text.hexdigest() if self.n_groups else ""

    def fold(self) -> None:
        if len(self.pairs) > 1:
            pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
            links = np.zeros(pairs.size, np.int64)
            np.add.at(links, at, np.concatenate(self.links))
            self.pairs, self.links = [pairs], [links]


def _segments(a: np.ndarray, b: np.ndarray, enc: Encoders) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Both sequences cut, after about SEGMENT tokens of A, where both end a token."""
    if a.size <= SEGMENT:
        yield a, b
        return
    end_a, end_b = np.cumsum(enc.size_a[a]), np.cumsum(enc.size_b[b])
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    cut = np.searchsorted(end_a, common) + 1
    i = j = 0
    while i < a.size:
        to = int(cut[min(np.searchsorted(cut, i + SEGMENT), cut.size - 1)])
        upto = int(np.searchsorted(end_b, end_a[to - 1])) + 1
        yield a[i:to], b[j:upto]
        i, j = to, upto


def _align(owners: list[_Document], segments: list[tuple[np.ndarray, np.ndarray]], enc: Encoders) -> None:
    """Adds the segments' numbers to their documents; all segments are laid end to end and worked through at once."""
    a, b = (np.concatenate([s[k] for s in segments]) for k in (0, 1))
    len_a, len_b = enc.size_a[a], enc.size_b[b]
    group_a, group_b = groups(len_a, len_b)
    n_groups = int(group_a[-1]) + 1
    last = np.cumsum([s[0].size for s in segments])  # a segment ends with a group
    stop = group_a[last - 1] + 1
    owner = np.repeat(np.arange(len(segments)), np.diff(np.concatenate(([0], stop))))
    over = np.bincount(owner[group_a[overlaps(len_a, len_b)[0]]], minlength=len(segments))
    total = np.bincount(owner, np.bincount(group_a, minlength=n_groups) * np.bincount(group_b, minlength=n_groups).astype(float), len(segments))
    text, ends = group_text(a, group_a, b, group_b, enc.digits)
    raw, ends = text.tobytes(), np.concatenate(([0], ends))
    doc, pair, links = group_links(owner, a, group_a, b, group_b)
    cuts = np.searchsorted(doc, np.arange(len(segments) + 1))
    begin = 0
    for i, d in enumerate(owners):
        d.text.update(d.held + raw[ends[begin]:ends[stop[i]] - 1])
        d.held = b";"
        d.n_groups += int(stop[i]) - begin
        d.n_overlaps += int(over[i])
        d.n_links += int(total[i])
        d.pairs.append(pair[cuts[i]:cuts[i + 1]])
        d.links.append(links[cuts[i]:cuts[i + 1]])
        if len(d.pairs) > 8:
            d.fold()
        begin = int(stop[i])


def _align_batches(byte_path: str, piece_path: str):
    def out(docs: list[tuple[int | None, _Document]]) -> pa.RecordBatch:
        for _, d in docs:
            d.fold()
        flat = [[x for _, d in docs for x in part(d)] for part in (lambda d: d.pairs, lambda d: d.links)]
        ends = pa.array(np.cumsum([0, *(sum(map(len, d.pairs)) for _, d in docs)]).astype(np.int32))
        return pa.record_batch([
            pa.array([i for i, _ in docs], pa.int64()),
            *(pa.array([getattr(d, k) for _, d in docs], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")),
            pa.array([d.digest() for _, d in docs], pa.string()),
            *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))) for x in flat),
        ], ["doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "groups_sha256", "pairs", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoders(byte_path, piece_path)
        docs, owners, segments, held = [], [], [], 0
        for batch in batches:
            codes = batch.column("text").dictionary_encode().indices.fill_null(-1).to_numpy()
            copies = set(np.flatnonzero(np.bincount(codes + 1) > 1).tolist())
            seen: dict[int, _Document] = {}  # copies in a batch are worked through once
            for at, code in enumerate((codes + 1).tolist()):
                if code in seen:
                    docs.append((batch.column("doc_id")[at].as_py(), seen[code]))
                    continue
                a, b = enc.encode(batch.column("text")[at].as_py())
                d = _Document(a, b)
                if code in copies:
                    seen[code] = d
                docs.append((batch.column("doc_id")[at].as_py(), d))
                for segment in _segments(a, b, enc) if a.size else ():
                    owners.append(d)
                    segments.append(segment)
                    held += segment[0].size
                    if held >= SEGMENT:
                        _align(owners, segments, enc)
                        owners, segments, held = [], [], 0
                if len(docs) >= 4096 and segments:
                    _align(owners, segments, enc)
                    owners, segments, held = [], [], 0
                if not segments and (len(docs) >= 256 or sum(len(x) for _, d in docs for x in d.pairs) > 4 * SEGMENT):
                    yield out(docs)
                    docs = []
        if segments:
            _align(owners, segments, enc)
        if docs:
            yield out(docs)

    return run


def _known_batches(shared):
    """Rows (row, n_best, count_sum, pairs, links): what the broadcast pairs add up to, and the other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = shared.value
        for b in batches:
            ends = b.column("pairs").offsets.to_numpy()
            mine = slice(int(ends[0]), int(ends[-1]))
            p, n = b.column("pairs").values.to_numpy()[mine], b.column("links").values.to_numpy()[mine]
            owner = np.repeat(np.arange(b.num_rows), np.diff(ends))
            at = np.minimum(np.searchsorted(pair, p), max(pair.size - 1, 0))
            known = pair[at] == p if pair.size else np.zeros(p.size, bool)
            n_best, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            np.add.at(total, owner[known], n[known] * count[at[known]])
            np.add.at(n_best, owner[known], n[known] * best[at[known]])
            rest = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[~known], minlength=b.num_rows)))).astype(np.int32))
            yield pa.record_batch([
                b.column("row"), pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(rest, pa.array(p[~known])), pa.ListArray.from_arrays(rest, pa.array(n[~known])),
            ], ["row", "n_best", "count_sum", "pairs", "links"])

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how many documents hold each linked id pair, and whether no pair of its first id is in more."""
    counts = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")))
    first = F.shiftright("pair", SHIFT).alias("first")
    most = stage(counts.groupBy(first).agg(F.max("count").alias("most")))  # one row an id of the first tokenizer
    named = counts.select("pair", "count", first)
    return named.join(most, "first").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str, head: int = HEAD) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum, groups_sha256, pairs, links) of every row.

    ``pairs`` holds the linked id pairs (first id << SHIFT | second id), ``links`` how often each is linked.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = keyed.mapInArrow(
        _align_batches(byte_path, piece_path),
        "doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, groups_sha256 string, pairs array<long>, links array<long>")
    aligned = stage(made.withColumn("row", F.monotonically_increasing_id()))
    counts = stage(pair_counts(aligned))
    held = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    least = held // head + 1  # at most ``head`` pairs are in so many documents
    hot = counts.filter(F.col("count") >= least).toArrow().sort_by("pair")
    shared = docs.sparkSession.sparkContext.broadcast((
        hot.column("pair").to_numpy(), hot.column("count").to_numpy(), hot.column("best").to_numpy().astype(np.int64)))
    known = stage(aligned.select("row", "pairs", "links").mapInArrow(
        _known_batches(shared), "row long, n_best long, count_sum long, pairs array<long>, links array<long>"))
    rest = known.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("n"))
    joined = rest.join(counts.filter(F.col("count") < least), "pair").select(
        "row", F.when(F.col("best"), F.col("n")).otherwise(0).alias("n_best"), (F.col("n") * F.col("count")).alias("count_sum"))
    sums = known.select("row", "n_best", "count_sum").unionByName(joined).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256", "pairs", "links")
