"""Benchmark decontamination by winnowing.

A text's fingerprints are the least of every six consecutive 5-gram hashes. Two texts that share ten consecutive
words share six 5-grams in a row, hence the least of them: no shared window of ten words is missed. Fingerprints
of documents and of benchmark items are joined; every hit is extended to the ten-word windows around it, and
these are compared as strings. An item of fewer than ten words is a single window; for each such length
(nine at most) its whole length is the gram.

Windows shared by many items are looked up once: a window's items are named by a code (count and xor of hashes of
the item ids), and a document meets each distinct set of items once.

Defined results: null texts have no words; an item without words has no window; documents that repeat doc_id and
text are one document, reported per row; a null item_id is the empty string in the list; an empty benchmark finds
nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.common import ascii_lower, explode_once, let, same
from exprspark.session import stage

SPAN = 10
GRAM = 5
GUARD = SPAN - GRAM + 1
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def benchmark_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def fingerprints(ws: Column) -> Column:
    """(fp, at): the 5-grams that are the least of some six in a row. ``ws`` must be a plain column or a lambda's."""

    def chosen(h: Column) -> Column:
        least = F.transform(F.sequence(F.lit(0), F.size(h) - GUARD), lambda i: F.least(*[F.get(h, i + k) for k in range(GUARD)]))
        return let(least, lambda m: F.filter(
            F.transform(h, lambda v, p: F.when(v == F.greatest(*[F.get(m, p - k) for k in range(GUARD)]), F.struct(v.alias("fp"), p.alias("at")))),
            lambda x: x.isNotNull()))

    hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - GRAM), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(GRAM)]))
    return F.when(F.size(ws) >= SPAN, let(hashes, chosen))


def _grams(ws: Column, length: int) -> Column:
    """(fp, at) of all windows of ``length`` words."""
    return F.when(F.size(ws) >= length, F.transform(
        F.sequence(F.lit(0), F.size(ws) - length),
        lambda i: F.struct(F.xxhash64(F.lit(length), F.array_join(F.slice(ws, i + 1, length), " ")).alias("fp"), i.alias("at"))))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, gram): the distinct windows of every item as strings."""

    def of(w: Column) -> Column:
        n = F.least(F.size(w), F.lit(SPAN))
        return F.when(n > 0, F.transform(
            F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(n.alias("length"), F.array_join(F.slice(w, i + 1, n), " ").alias("gram"))))

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return explode_once(items, let(benchmark_words(F.col("text")), of), "item_id").distinct()


def _marks(text: Column, short: list[int], whole: bool) -> Column:
    """(length, fp, at) of one text. ``whole``: of an item, whose short form is one window."""

    def of(w: Column) -> Column:
        tag = lambda found, n: F.transform(F.coalesce(found, F.array()), lambda x: F.struct(F.lit(n).alias("length"), x["fp"].alias("fp"), x["at"].alias("at")))
        out = tag(fingerprints(w), SPAN)
        for n in short:
            grams = F.when(F.size(w) == n, _grams(w, n)) if whole else _grams(w, n)
            out = F.concat(out, tag(grams, n))
        return out

    return let(benchmark_words(text), of)


def _hits(docs: DataFrame, benchmark: DataFrame, short: list[int]) -> DataFrame:
    """(doc_id, text_hash, length, at): the fingerprints that a document has in common with any item."""
    marks = stage(explode_once(benchmark, _marks(F.col("text"), short, True)).select("length", "fp").distinct())
    spread = explode_once(docs, _marks(F.col("text"), short, False), "doc_id", "text_hash")
    met = spread.join(marks, ["length", "fp"])
    return met.groupBy("doc_id", "text_hash", "length").agg(F.array_sort(F.collect_set("at")).alias("at"))


def matches(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per document with a hit: covered words, and its items.

    The first table has (doc_id, text_hash, n_hit), the second (doc_id, text_hash, n_items, items). The list of items
    is bounded by the benchmark; positions are bounded by the document.
    """
    windows = stage(item_windows(benchmark))
    sets = windows.groupBy("length", "gram").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("item_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "item_id")).alias("y"))
    sets = stage(sets.select("length", "gram", F.struct("n", "x", "y").alias("items_code")))
    short = sorted(r[0] for r in windows.filter(F.col("length") < SPAN).select("length").distinct().collect())  # nine at most
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    hits = stage(_hits(keyed, benchmark, short))
    texts = keyed.join(hits, same(keyed, hits, "doc_id", "text_hash")).select(
        hits["doc_id"], hits["text_hash"], hits["length"], hits["at"], keyed["text"])

    def around(w: Column) -> Column:
        starts = F.when(F.col("length") == SPAN, F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(
            F.greatest(p - GUARD + 1, F.lit(0)), F.least(p, F.size(w) - SPAN)))))).otherwise(F.col("at"))
        return F.transform(starts, lambda s: F.struct(s.alias("s"), F.array_join(F.slice(w, s + 1, F.col("length")), " ").alias("gram")))

    spans = explode_once(texts, let(benchmark_words(F.col("text")), around), "doc_id", "text_hash", "length")
    # rows that repeat doc_id and text meet again here: groups below count each place once
    real = stage(spans.join(sets, ["length", "gram"])
                 .select("doc_id", "text_hash", "s", "length", "gram", "items_code").distinct())
    runs = real.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("length")).alias("e")))).alias("r"))
    n_hit = F.aggregate("r", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda a, x: F.struct(
        F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("n")), lambda a: a["n"])
    met = real.select("doc_id", "text_hash", "items_code").distinct()
    one = sets.groupBy("items_code").agg(F.min(F.struct("length", "gram")).alias("g"))
    members = one.join(windows, (F.col("g.length") == windows["length"]) & (F.col("g.gram") == windows["gram"])).select("items_code", "item_id")
    items = met.join(members, "items_code").groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return runs.select("doc_id", "text_hash", n_hit.alias("n_hit")), items.select("doc_id", "text_hash", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit, items = matches(docs, benchmark)
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(benchmark_words(F.col("text"))).cast("long").alias("n_words"))
    found = n_hit.join(items, same(n_hit, items, "doc_id", "text_hash")).select(n_hit["doc_id"], n_hit["text_hash"], "n_hit", "n_items", "items")
    out = base.join(found, same(base, found, "doc_id", "text_hash"), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        base["doc_id"], "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, with all their columns."""
    # written first: with its size known, Spark broadcasts a short list instead of shuffling all texts
    found = stage(matches(docs, benchmark)[0].select("doc_id", "text_hash"))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    return rows.join(found, same(rows, found, "doc_id", "text_hash"), "left_anti").select("_row.*")
