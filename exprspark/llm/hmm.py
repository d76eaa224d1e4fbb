"""LM scoring with a hidden Markov model over all tokens of the corpus.

Counts of every training token are taken over the whole corpus. A token with at least one ``CLASSES``-th of all
tokens is a class of its own (so there are at most ``CLASSES`` such), all others fall into classes by form (length,
capital, last letters). States emit classes, a class emits its tokens by their counts, so

    log10 P(text) = log10 P(classes), by the scaled forward recursion, + sum of log10 P(token | class).

Baum-Welch counts of all training texts are summed per task, then across partitions, and the bounded sums come to the
driver for the next round. Rounds go on until the log-likelihood of the training texts, together with that of the one
token of weight spread over each distribution, gains less than ``GAIN`` of itself; no round can lower that sum.

Counts of tokens with at least one ``HEAD``-th of all tokens are broadcast (at most ``HEAD``). The others, none of
them frequent, are kept with their text and meet their counts in a join; nothing there grows into a hot key. Texts are split
into tokens twice: for the counts, and for the class sequences that all rounds read.

A task works on about ``BYTES`` of text at a time and on blocks of ``BLOCK`` tokens; a longer text is walked in segments: forward
values are kept where a segment begins, and the others are computed again on the way back.

Defined results: a null text is empty and has its end token only; a null doc_id has the checksum of the empty string,
so it is held out; rows that repeat doc_id and text get the same result and each count for training; without training
texts all counts are zero and the model is the uniform one; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.session import stage

STATES = 6
#: training ends with the first round that gains less than this share of the log-likelihood
GAIN = 1e-5
CLASSES, SHAPES, HEAD = 8192, 2048, 1 << 20
ADD = 0.1
#: tokens in one block of the recursions, and bytes of a batch that are worked on at a time: both bound memory
BLOCK, BYTES = 500_000, 12 << 20
#: times between two scalings; products of so many emissions stay far above the smallest double
EVERY = 8
END = ""  # no word is empty


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts in one array, and the number of each text's."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, rows = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    full = pc.not_equal(pc.binary_length(flat), 0)
    rows = rows[full.to_numpy(zero_copy_only=False)]
    return flat.filter(full), np.bincount(rows, minlength=len(lists))


def shapes(words: pa.Array) -> np.ndarray:
    """Form class of each word: a checksum of its length range, first capital and last two letters."""
    if not len(words):
        return np.zeros(0, np.int64)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    core = pc.utf8_rtrim(words, ".,;:!?")
    tail = pc.dictionary_encode(pc.utf8_slice_codeunits(core, start=-2, stop=None))
    names = [x.encode() for x in tail.dictionary.to_pylist()]
    upper = pc.not_equal(pc.binary_length(core), pc.binary_length(words)).to_numpy(zero_copy_only=False)
    kind = np.digitize(size, [3, 5, 8, 12, 20]) * 2 + upper
    table = np.array([[zlib.crc32(n + bytes([k])) % SHAPES for k in range(12)] for n in names], np.int64)
    return table[tail.indices.to_numpy(zero_copy_only=False), kind]


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut where ``column`` holds about BYTES."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, at = np.cumsum(size), 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(upto, upto[at] - size[at] + BYTES, "right")))
            yield b.slice(at, to - at)
            at = to


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _pieces(batches, "text"):
        flat, _ = tokens(b.column("text"))
        found = pc.value_counts(flat)
        yield pa.record_batch([
            pa.concat_arrays([found.field("values").cast(pa.string()), pa.array([END])]),
            pa.concat_arrays([found.field("counts"), pa.array([b.num_rows], pa.int64())])], ["token", "c"])


def _shape_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s, c = shapes(b.column("token")), b.column("c").to_numpy()
        yield pa.record_batch([
            pa.array(np.arange(SHAPES)), pa.array(np.bincount(s, c, SHAPES).astype(np.int64)), pa.array(np.bincount(s, minlength=SHAPES).astype(np.int64))], ["shape", "c", "v"])


class Vocabulary:
    """What tasks need of the counts: the frequent tokens, and the totals of the form classes."""

    def __init__(self, total: int, distinct: int, head: pa.Table, by_shape: list[tuple[int, int, int]]):
        order = sorted(zip(head.column("c").to_pylist(), head.column("token").to_pylist()), key=lambda x: (-x[0], x[1]))
        self.total, self.distinct = total, distinct
        self.head = pa.array([t for _, t in order], pa.string())
        self.counts = np.array([c for c, _ in order], np.int64)
        self.own = int((self.counts * CLASSES >= max(total, 1)).sum())
        self.classes = self.own + SHAPES
        c, v = np.zeros(SHAPES), np.zeros(SHAPES)
        for s, n, k in by_shape:
            c[s], v[s] = n, k
        own = self.head[:self.own]  # tokens with a class of their own leave their form class
        left = shapes(own)
        c -= np.bincount(left, self.counts[:self.own], SHAPES)
        v -= np.bincount(left, minlength=SHAPES)
        self.norm = np.log10(c + ADD * (v + 1))
        share = np.concatenate((self.counts[:self.own], c)) + ADD
        self.share = share / share.sum()
        self.log_count = np.log10(self.counts + ADD)
        end = pc.index(self.head, END).as_py()
        self.end = end if end >= 0 else None

    def lookup(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=self.head), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def class_of(self, words: pa.Array, at: np.ndarray) -> np.ndarray:
        out = at.copy()
        rest = (at < 0) | (at >= self.own)
        out[rest] = self.own + shapes(words.filter(pa.array(rest)))
        return out


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


MEASURED = "doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, extra double, classes binary, rare array<string>, rare_times array<long>"


def _measure(vocabulary):
    """Class sequence, the sums that need no join, and the tokens outside the broadcast, of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        end = pa.array([END])
        end_at = v.lookup(end)
        end_class = int(v.class_of(end, end_at)[0])
        end_c = float(v.counts[end_at[0]]) if end_at[0] >= 0 else 0.0  # without training texts the end is unknown
        end_extra = np.log10(end_c + ADD) - v.norm[end_class - v.own] if end_class >= v.own else 0.0
        tail = np.array([end_class], "<u4").tobytes()
        for b in _pieces(batches, "text"):
            words, sizes = tokens(b.column("text"))
            at = v.lookup(words)
            cls = v.class_of(words, at)
            inside = at >= 0
            log_c = np.where(inside, v.log_count[np.maximum(at, 0)] if v.log_count.size else 0.0, 0.0)
            formed = cls >= v.own
            extra = np.where(formed, log_c - v.norm[np.maximum(cls - v.own, 0)], 0.0)
            joined = cls.astype("<u4").tobytes()
            ends = np.cumsum(sizes)
            rows = np.repeat(np.arange(b.num_rows), sizes)[~inside]
            coded = pc.dictionary_encode(words.filter(pa.array(~inside)))
            k = max(len(coded.dictionary), 1)
            pairs, times = np.unique(rows * k + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(b.num_rows + 1) * k).astype(np.int32))
            yield pa.record_batch([
                b.column("doc_id"), b.column("held_out"), pa.array(sizes.astype(np.int64) + 1),
                pa.array(_sums(inside.astype(float), sizes).astype(np.int64) + int(end_c > 0)),
                pa.array(_sums(log_c, sizes) + np.log10(end_c + ADD)), pa.array(_sums(extra, sizes) + end_extra),
                pa.array([joined[4 * x:4 * y] + tail for x, y in zip((ends - sizes).tolist(), ends.tolist())], pa.binary()),
                pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(pairs % k)).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
            ], ["doc_id", "held_out", "n_tokens", "n_head", "head_log", "extra", "classes", "rare", "rare_times"])

    return run


class Model:
    """Initial, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # emit: classes x states

    @classmethod
    def first(cls, share: np.ndarray) -> Model:
        """Every state near the class shares, mostly staying where it is."""
        noise = np.random.default_rng(7).random((share.size, STATES))
        emit = share[:, None] * (0.5 + noise)
        move = np.full((STATES, STATES), 0.1 / max(STATES - 1, 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def counted(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        """From summed counts, with one token's weight spread over each distribution."""
        start, move, emit = start + 1 / STATES, move + 1 / STATES, emit + share[:, None]
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def prior(self, share: np.ndarray) -> float:
        """Log-likelihood of the weight that ``counted`` spreads."""
        return float((np.log(self.start).sum() + np.log(self.move).sum()) / STATES + (share[:, None] * np.log(self.emit)).sum())

    def blocks(self, sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Sequences in blocks of similar length: their numbers, classes by time, and how many go on at each time."""
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        at = 0
        while at < len(order):
            size, to = 0, at
            while to < len(order) and (to == at or size + len(sequences[order[to]]) <= BLOCK):
                size += len(sequences[order[to]])
                to += 1
            mine = np.array(order[at:to])
            lengths = np.array([len(sequences[i]) for i in mine])
            live = mine.size - np.cumsum(np.bincount(lengths, minlength=lengths[0] + 1))[:lengths[0]]
            # the longest come first, so the i-th sequence's token of time t has place i among the live ones of that time
            first = np.cumsum(live) - live
            cls = np.empty(size, np.int64)
            for i, j in enumerate(mine.tolist()):
                cls[first[:lengths[i]] + i] = sequences[j]
            yield mine, cls, live
            at = to

    def forward(self, cls: np.ndarray, live: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward values, scales, and emissions, by time; ``before`` are the values ahead of the first time.

        Values are scaled to a sum of one at every ``EVERY``-th and the last time, where their sum is the scale; it is one at the others.
        """
        emit = np.take(self.emit, cls, axis=0)
        alpha, scale, ones = np.empty_like(emit), np.ones(cls.size, emit.dtype), np.ones(STATES, emit.dtype)
        a, e = before, 0
        for t, n in enumerate(live.tolist()):
            s, e = e, e + n
            here = alpha[s:e]
            if a is None:
                np.multiply(self.start, emit[s:e], out=here)
            else:
                np.matmul(a[:n], self.move, out=here)
                here *= emit[s:e]
            if t % EVERY == EVERY - 1 or t == live.size - 1:
                c = scale[s:e]
                np.matmul(here, ones, out=c)
                here /= c[:, None]
            a = here
        return alpha, scale, emit

    @staticmethod
    def _places(live: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
        """The sequence of every value, and which values are a sequence's last; ``more`` sequences go on behind."""
        who = np.arange(live.sum()) - np.repeat(np.cumsum(live) - live, live)
        return who, np.flatnonzero(who >= np.repeat(np.concatenate((live[1:], [more])), live))

    def score(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 likelihood of each sequence."""
        out = np.zeros(len(sequences))
        for mine, parts in self._parts(sequences):
            a = None
            for i, (cls, live) in enumerate(parts):
                alpha, scale, _ = self.forward(cls, live, a)
                who, last = self._places(live, int(i < len(parts) - 1))
                out[mine] += np.bincount(who, np.log10(scale), mine.size)
                out[mine[who[last]]] += np.log10(alpha[last].sum(axis=1))
                a = alpha[-1:]
        return out

    def _parts(self, sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """Blocks; that of a single long sequence is cut into segments."""
        for mine, cls, live in self.blocks(sequences):
            step = BLOCK if mine.size == 1 else cls.size
            yield mine, [(cls[at:at + step], live[at:at + step] if mine.size == 1 else live) for at in range(0, cls.size, step)]

    def expect(self, sequences: list[np.ndarray], sums: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
        """Adds expected starts, moves and emissions; the log-likelihood of the sequences."""
        likelihood = 0.0
        for _, parts in self._parts(sequences):
            edges: list[np.ndarray | None] = [None]
            for part in parts[:-1]:
                edges.append(self.forward(*part, edges[-1])[0][-1:].copy())
            after = None
            for part, edge in zip(reversed(parts), reversed(edges)):
                gained, after = self._back(*part, edge, after, sums)
                likelihood += gained
        return likelihood

    def _back(self, cls: np.ndarray, live: np.ndarray, edge: np.ndarray | None, after: np.ndarray | None, sums) -> tuple[float, np.ndarray]:
        """Both ways through one block between ``edge`` and ``after``: adds its counts, gives its log-likelihood and what the block before continues with."""
        start, move, emitted = sums
        alpha, scale, emit = self.forward(cls, live, edge)
        _, last = self._places(live, 0 if after is None else after.shape[0])
        ends = alpha[last].sum(axis=1)
        likelihood = float(np.log(scale[scale != 1].astype(np.float64)).sum() + np.log(ends.astype(np.float64)).sum())
        beta, behind, back = np.empty_like(alpha), after, np.ascontiguousarray(self.move.T)
        beta[last] = 1 / ends[:, None]
        s = cls.size
        for t in range(live.size - 1, -1, -1):
            s, e = s - int(live[t]), s
            if after is not None:
                np.matmul(after, back, out=beta[s:s + after.shape[0]])
            after = emit[s:e]  # from here on what the time before continues with
            after *= beta[s:e]
            if t % EVERY == EVERY - 1 or t == live.size - 1:
                after /= scale[s:e, None]
        n = int(live[0])
        if behind is not None:
            move += self.move * (alpha[-1:].T @ behind)
        prior = np.arange(n, cls.size) - np.repeat(live[:-1], live[1:])  # the same sequence one time earlier
        for at in range(0, prior.size, 8192):
            move += self.move * (np.take(alpha, prior[at:at + 8192], axis=0).T @ emit[n + at:n + at + 8192])
        alpha *= beta  # from here on the states' probabilities
        if edge is None:
            start += alpha[:n].sum(axis=0, dtype=np.float64)
        for j in range(STATES):
            emitted[:, j] += np.bincount(cls, alpha[:, j], emitted.shape[0])
        return likelihood, after.copy()


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u4") for x in column]


def _expect(model):
    """Counts of one task: a row per class, and rows below zero for the log-likelihood, moves and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        sums = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(m.emit.shape)
        likelihood = np.zeros((1, STATES))
        for b in _pieces(batches, "classes"):
            likelihood[0, 0] += m.expect(_sequences(b.column("classes")), sums)
        used = np.flatnonzero(sums[2].any(axis=1))
        rows = np.concatenate((np.arange(-2 - STATES, 0), used))
        values = np.concatenate((likelihood, sums[1], sums[0][None], sums[2][used]))
        yield pa.record_batch([pa.array(rows), *[pa.array(values[:, j].copy()) for j in range(STATES)]], ["at", *[f"v{j}" for j in range(STATES)]])

    return run


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches, "classes"):
            names = [n for n in b.schema.names if n != "classes"]
            yield pa.record_batch([*[b.column(n) for n in names], pa.array(model.value.score(_sequences(b.column("classes"))))], [*names, "hmm"])

    return run


def _train(rows: DataFrame, vocabulary: Vocabulary) -> Model:
    spark, model = rows.sparkSession, Model.first(vocabulary.share)
    schema = "at long, " + ", ".join(f"v{j} double" for j in range(STATES))
    known = rows.filter("NOT held_out")
    before = -np.inf
    while True:
        shared = spark.sparkContext.broadcast(model)
        found = known.select("classes").mapInArrow(_expect(shared), schema).groupBy("at").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(STATES)]).toArrow()
        shared.unpersist()
        at = found.column("at").to_numpy()
        values = np.stack([found.column(f"v{j}").to_numpy() for j in range(STATES)], axis=1) if len(at) else np.zeros((0, STATES))
        table = np.zeros((vocabulary.classes + STATES + 2, STATES))
        table[at + STATES + 2] = values
        reached = table[0, 0] + model.prior(vocabulary.share)
        if not table.any() or reached - before < GAIN * abs(reached):
            break
        before, model = reached, Model.counted(table[STATES + 1], table[1:STATES + 1], table[STATES + 2:], vocabulary.share)
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    counts = stage(keyed.filter("NOT held_out").select("text").mapInArrow(_count_batches, "token string, c long").groupBy("token").agg(F.sum("c").alias("c")))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = F.col("c") * HEAD >= total
    by_shape = counts.mapInArrow(_shape_batches, "shape long, c long, v long").groupBy("shape").agg(F.sum("c").alias("c"), F.sum("v").alias("v"))
    vocabulary = Vocabulary(total, distinct, counts.filter(frequent).toArrow(), [tuple(r) for r in by_shape.collect()])
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = stage(keyed.mapInArrow(_measure(shared), MEASURED).withColumn("row", F.monotonically_increasing_id()))
    model = spark.sparkContext.broadcast(_train(rows, vocabulary))
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_head", "head_log", "extra"]
    scored = rows.select(*kept, "classes").mapInArrow(_score(model), "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, extra double, hmm double")

    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.rare_times").alias("tf"))
    met = rare.join(counts.filter(~frequent), "token", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("log_c"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"))
    out = scored.join(sums, "row", "left").na.fill(0, ["log_c", "known"])
    norm = float(np.log10(total + ADD * (distinct + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.col("known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.col("log_c") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("hmm") + F.col("extra") + F.col("log_c")).alias("score"))
