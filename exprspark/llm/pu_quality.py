"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are training documents labelled 1, the unlabelled set is training web text, labels unseen.
With the class prior p the risk of labelling unlabelled text negative, less p times that of the positives, estimates the
negatives' risk without bias; where a batch makes it negative the step goes back up instead (the non-negative form).

The prior is estimated from the labels: the share of 1 among the labelled training rows, within [0.05, 0.95].
Features are counts over the whole text: its make-up (word length, symbols, marks, capitals, digits, repeats of words and of
lines, size) and hashed short letter groups of a word's edges, as rates. Their centre and scale are taken over every
training row. Positives are a bounded sample of the labelled rows: at most ``MAX_ROWS``, those with the smallest hash of the
doc_id. The unlabelled risk is that of all training rows: steps on mini-batches of a sample of as many rows only choose where
to begin, then ``STEPS`` steps follow whose gradient is summed by Spark over every training row. Scores use the text alone.

Defined results: a null or empty text is scored like any other, from zero rates; a null doc_id has the checksum of the
empty string; labels that disagree for a doc_id count as 1 if their mean is over 0.5, null labels are dropped; of several
texts of a sampled doc_id the one with the smallest hash is taken; without positives every score is the prior; rows that
repeat get the same score, and each counts in the unlabelled risk; other columns are ignored.
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

MAX_ROWS = 10_000
HASHED = 512
EPOCHS, BATCH, RATE, DECAY = 60, 512, 0.05, 1e-4
#: steps over all training rows, and their rate
STEPS, STEP = 25, 0.02
#: characters counted one by one as rates
MARKS = "#*$%&|<>!?.,;:()[]{}=_/\\\"'-@"
DENSE = 12 + len(MARKS)


def training_row(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 != 1


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text."""
    out = np.zeros((len(texts), DENSE + HASHED))
    if not len(texts):
        return out
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    words, rows = words.filter(pa.array(full)), rows[full]
    n = np.bincount(rows, minlength=len(lists))
    per = np.maximum(n, 1)
    coded = pc.dictionary_encode(words)
    names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(float)
    mean = lambda x: np.bincount(rows, x[code], len(lists)) / per if code.size else np.zeros(len(lists))
    lower = pc.utf8_lower(names)
    flag = lambda a: a.to_numpy(zero_copy_only=False).astype(float)
    shout = flag(pc.and_(pc.utf8_is_upper(names), pc.greater(pc.utf8_length(names), 1)))
    title, digit = flag(pc.utf8_is_title(names)), flag(pc.match_substring_regex(names, "[0-9]"))
    link = flag(pc.match_substring_regex(lower, "https?://|www[.]|@"))
    distinct = np.unique(rows * max(len(names), 1) + code) // max(len(names), 1) if code.size else rows
    repeat = 1 - np.bincount(distinct, minlength=len(lists)) / per
    again = np.zeros(len(lists))
    if code.size > 1:  # a word followed by itself
        np.add.at(again, rows[1:][(code[1:] == code[:-1]) & (rows[1:] == rows[:-1])], 1)
    chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    lines = pc.split_pattern(texts, "\n")
    n_lines = lines.value_lengths().to_numpy(zero_copy_only=False)
    line_rows = np.repeat(np.arange(len(lists)), n_lines)
    line_code = pc.dictionary_encode(lines.flatten()).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    k = int(line_code.max(initial=0)) + 1
    line_repeat = 1 - np.bincount(np.unique(line_rows * k + line_code) // k, minlength=len(lists)) / np.maximum(n_lines, 1)
    dense = [np.log1p(n), mean(size), np.sqrt(np.maximum(mean(size ** 2) - mean(size) ** 2, 0)), mean(shout), mean(title), mean(digit), mean(link),
             repeat * np.minimum(n, 200) / 200, again / per, line_repeat, np.log1p(per / np.maximum(n_lines, 1)), (n < 20).astype(float)]
    dense += [pc.count_substring(texts, m).to_numpy(zero_copy_only=False) / per for m in MARKS]
    out[:, :DENSE] = np.stack(dense, axis=1)
    # hashed two-letter edges of the words
    slot = np.zeros((2, len(names)), np.int64)
    for i, part in enumerate((pc.utf8_slice_codeunits(lower, 0, 2), pc.utf8_slice_codeunits(lower, -2, None))):
        d = pc.dictionary_encode(part)
        table = np.array([zlib.crc32(bytes([i]) + x.encode()) % HASHED for x in d.dictionary.to_pylist()], np.int64)
        if table.size:
            slot[i] = table[d.indices.to_numpy(zero_copy_only=False)]
    for i in range(2):
        if code.size:
            out[:, DENSE:] += np.bincount(rows * HASHED + slot[i][code], minlength=len(lists) * HASHED).reshape(len(lists), HASHED)
    out[:, DENSE:] = np.sqrt(out[:, DENSE:] / per[:, None])
    return out


class Model:
    """A linear model over standardised features."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float):
        self.centre, self.scale, self.weights, self.bias = centre, scale, weights, bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights + self.bias, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, spread: tuple[np.ndarray, np.ndarray] | None = None) -> Model:
    """Adam steps on p R+(positive) + max(0, R-(unlabelled) - p R-(positive)) with the logistic loss.

    ``spread`` is the mean and deviation of each feature; without it, those of ``unlabelled``.
    """
    width = positive.shape[1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(prior / (1 - prior))))
    centre, scale = spread or (unlabelled.mean(axis=0), unlabelled.std(axis=0))
    scale = scale + 1e-3
    p, u = (np.clip((x - centre) / scale, -8, 8) for x in (positive, unlabelled))
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v, t, rng = np.zeros(width + 1), np.zeros(width + 1), 0, np.random.default_rng(11)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = lambda z: np.logaddexp(0, z)  # of calling z negative
    for epoch in range(EPOCHS):
        steps = max(1, len(u) // BATCH)
        for us, ps in zip(np.array_split(rng.permutation(len(u)), steps), np.array_split(rng.permutation(max(len(p), steps)) % len(p), steps)):
            zu, zp = u[us] @ w + b, p[ps] @ w + b
            negative = loss(zu).mean() - prior * loss(zp).mean()
            gu, gp = sig(zu) / len(us), sig(zp) / len(ps)  # of the two losses of calling negative
            if negative >= 0:
                du, dp = gu, -prior * (1 - sig(zp)) / len(ps) - prior * gp
            else:  # undo the over-fit part
                du, dp = -gu, prior * gp
            g = np.append(u[us].T @ du + p[ps].T @ dp + DECAY * w, du.sum() + dp.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = RATE / (1 + epoch / 10) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    return Model(centre, scale, w, b)


def _sample(rows: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of at most MAX_ROWS rows, one per doc_id, by the smallest hash of it; made in tasks, only numbers come to the driver.

    The ids are chosen without the texts, so that only texts of the sample are shuffled.
    """
    ids = stage(ids.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS))
    picked = rows.join(F.broadcast(ids), "doc_id", "left_semi")  # ids: MAX_ROWS at most
    picked = picked.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                x = features(b.column("text").slice(at, 500)).astype(np.float32)
                yield pa.record_batch([b.column("doc_id").slice(at, 500), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"])

    found = picked.select("doc_id", "text").mapInArrow(run, "doc_id long, x binary").toArrow().sort_by("doc_id").column("x").to_pylist()
    return np.frombuffer(b"".join(found), np.float32).reshape(-1, DENSE + HASHED).astype(float)


def _spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature over all rows: counts, sums and square sums per task, then over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(DENSE + HASHED), np.zeros(DENSE + HASHED)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                x = features(b.column("text").slice(at, 1000))
                n, total, square = n + len(x), total + x.sum(axis=0), square + (x * x).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(np.full(total.size, n)), pa.array(total), pa.array(square)], ["at", "n", "s", "q"])

    found = rows.select("text").mapInArrow(run, "at long, n long, s double, q double").groupBy("at").agg(*[F.sum(c).alias(c) for c in "nsq"]).toArrow().sort_by("at")
    if not len(found):
        return np.zeros(DENSE + HASHED), np.zeros(DENSE + HASHED)
    n, s, q = (found.column(c).to_numpy() for c in "nsq")
    mean = s / np.maximum(n, 1)
    return mean, np.sqrt(np.maximum(q / np.maximum(n, 1) - mean * mean, 0))


def _coded(rows: DataFrame, centre: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Standardised features of every row as 16-bit floats, written once for all steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                x = np.clip((features(b.column("text").slice(at, 1000)) - centre) / scale, -8, 8).astype(np.float16)
                yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary())], ["x"])

    return stage(rows.select("text").mapInArrow(run, "x binary"))


def _unlabelled_risk(coded: DataFrame, weights: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
    """Mean loss of calling every row negative, and its gradient (the bias last): summed per task, then over all tasks."""
    shared = coded.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b0 = shared.value
        total = np.zeros(w.size + 3)  # gradient, its bias, loss, rows
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                x = np.frombuffer(b"".join(b.column("x").slice(at, 2000).to_pylist()), np.float16).reshape(-1, w.size).astype(np.float32)
                z = (x @ w.astype(np.float32)).astype(float) + b0
                g = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                total += np.concatenate((x.T @ g.astype(np.float32), [g.sum(), np.logaddexp(0, z).sum(), len(z)]))
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total)], ["at", "v"])

    found = coded.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow().sort_by("at").column("v").to_numpy()
    shared.unpersist()
    n = max(found[-1], 1.0)
    return float(found[-2] / n), found[:-2] / n


def refine(model: Model, positive: np.ndarray, coded: DataFrame, prior: float, steps: int = STEPS) -> Model:
    """Steps on the same risk as ``fit``, with all rows of ``coded`` as the unlabelled text in each."""
    p = np.clip((positive - model.centre) / model.scale, -8, 8)
    w, b = model.weights.copy(), model.bias
    m, v = np.zeros(w.size + 1), np.zeros(w.size + 1)
    for t in range(1, steps + 1):
        called, gu = _unlabelled_risk(coded, w, b)
        zp = p @ w + b
        sig = 1 / (1 + np.exp(-np.clip(zp, -30, 30)))
        if called - prior * np.logaddexp(0, zp).mean() >= 0:
            dp = -prior * (1 - sig) / len(p) - prior * sig / len(p)
        else:
            gu, dp = -gu, prior * sig / len(p)
        g = gu + np.append(p.T @ dp + DECAY * w, dp.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = STEP / (1 + t / 10) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(model.centre, model.scale, w, b)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on training rows only."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(training_row(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") > 0.5).cast("int").alias("quality"))
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("quality"), F.lit(0))).first()
    prior = min(max(ones / n, 0.05), 0.95) if n else 0.5
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(training_row(F.col("doc_id")))
    ids = rows.select("doc_id")
    positive = ids.join(known.filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    trusted = _sample(rows, positive)
    begun = fit(trusted, _sample(rows, ids), prior, _spread(rows))
    return refine(begun, trusted, _coded(rows, begun.centre, begun.scale), prior) if len(trusted) else begun


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                s = model.value.score(features(b.column("text").slice(at, 1000)))
                yield pa.record_batch([b.column("doc_id").slice(at, 1000), b.column("held_out").slice(at, 1000), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                      ["doc_id", "held_out", "score", "predicted"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~training_row(F.col("doc_id"))).alias("held_out"), "text")
    return keyed.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
