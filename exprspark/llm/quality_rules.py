"""Quality rules with cutoffs that adapt to each language and source.

Every document gets a few whole-number metrics. A sketch per (lang, source) and metric counts values in
log-linear bins (64 bins per power of two at most, so a quantile is off by under 1/32 of itself). Sketches
merge by adding counts: per task before the shuffle, and again from (lang, source) to lang to everything.

Three numbers are read from a sketch: both quartiles, and the tail, the root mean square of how far values lie above the
upper quartile, each by at most ``CAP``. They are blended over the three levels: ``n`` documents of a group weigh ``n`` against
``PRIOR`` of its language, and those of a language likewise against all. So a group's own values count the more the more
it has, without a size at which anything switches. The cutoff is the upper quartile, plus ``SPREAD`` quartile ranges, plus
``REACH`` tails. Most texts have no symbols, repeated lines or repeated words at all, so both quartiles are 0 there, and the
tail follows how common such texts are in the group; capping keeps a few wild texts from raising it. For repeated words the
cutoff falls below the base rule wherever fewer than about one text in seven repeats anything.
Bins and counts are whole numbers, so any partitioning gives the same cutoffs.

Defined results: a null text has no words and fails; null lang or source are groups of their own; rows that
repeat are judged alike; an empty table gives an empty table; extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.common import HAS_WORD, covered, let, words
from exprspark.session import stage

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
#: tails above the quartiles that pass: the widest for metrics that are 0 in most texts, where the tail itself is small
REACH = {"symbols": 8, "dup_lines": 8, "repeats": 8, "word_length": 4}
SPREAD = 2
#: an excess counts up to this: 10% of words or lines, one letter of mean word length
CAP = 100
#: documents of the next level that a group's own numbers are weighed against
PRIOR = 100


def _repeat_words(ws: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text."""

    def exact(w: Column) -> Column:
        grams = F.array_sort(F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("g"), i.alias("p"))))
        return let(grams, lambda s: covered(F.array_sort(F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False))),
            lambda x: x["p"])), WINDOW))

    def checked(w: Column) -> Column:  # most texts repeat nothing: a set of hashes shows that
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact(w)))

    return let(ws, lambda w: F.when(F.size(w) > WINDOW, checked(w)).otherwise(F.lit(0).cast("long")))


def metrics(text: Column) -> Column:
    """The base counts of one text as a struct."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD))
    counts = let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    dups = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        counts.alias("c"), dups.alias("d"), F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"))


def _bin(v: Column) -> Column:
    """Bin of a whole number: exact below 64, then 32 bins for each power of two."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0)).cast("int")
    return F.when(v < 64, v).otherwise(F.call_function("shiftright", v, shift) + 32 * shift.cast("long"))


def _value(b: Column) -> Column:
    """The smallest value of a bin."""
    shift = F.greatest(F.call_function("div", b, F.lit(32)) - 1, F.lit(0)).cast("int")
    return F.when(b < 64, b).otherwise(F.call_function("shiftleft", b - 32 * shift.cast("long"), shift))


def _rates(m: str) -> dict[str, Column]:
    n = F.greatest(F.col(f"{m}.c.n_words"), F.lit(1).cast("long"))
    lines = F.greatest(F.col(f"{m}.d.n_lines"), F.lit(1).cast("long"))
    div = lambda a, b: F.call_function("div", a, b)
    return {
        "symbols": div(1000 * F.col(f"{m}.n_symbols"), n), "dup_lines": div(1000 * F.col(f"{m}.d.n_dup_lines"), lines),
        "repeats": div(1000 * F.col(f"{m}.c.n_repeat_words"), n), "word_length": div(100 * F.col(f"{m}.c.word_chars"), n),
    }


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, n): one mergeable sketch per language, source and metric."""
    pairs = [F.struct(F.lit(k).alias("metric"), _bin(v).alias("bin")) for k, v in _rates("_m").items()]
    return (measured.select("lang", "source", F.explode(F.array(*pairs)).alias("x"))
            .groupBy("lang", "source", "x.metric", "x.bin").agg(F.count("*").alias("n")))


def cutoffs(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, one column per metric): the largest value that passes.

    Sketches are merged upwards. A group's bins are at most some thousands, so its running sum is small.
    """
    levels = sketch.groupBy("lang", "source", "metric", "bin").agg(F.sum("n").alias("n"))
    by_lang = levels.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("n"))
    overall = by_lang.groupBy("metric", "bin").agg(F.sum("n").alias("n"))

    def shape(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        """Documents, and quartiles and tail of each metric; bins are one sorted array per group and metric, bounded by the number of bins."""
        bins = df.groupBy(*keys, "metric").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("b"), F.sum("n").alias("total"))
        running = F.aggregate("b", F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1), F.lit(0).cast("long")) + x["n"])))
        bins = bins.withColumn("r", running)
        at = lambda q: F.filter("b", lambda x, i: F.get(F.col("r"), i) * 4 >= F.col("total") * q)[0]["bin"]
        out = bins.select(*keys, "metric", "total", "b", _value(at(1)).alias("q1"), _value(at(3)).alias("q3"))
        above = lambda x: F.least(F.greatest(_value(x["bin"]) - F.col("q3"), F.lit(0).cast("long")), F.lit(CAP).cast("long"))
        squares = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + x["n"] * above(x) * above(x))
        numbers = F.struct(F.col("q1").cast("double").alias("q1"), F.col("q3").cast("double").alias("q3"), F.sqrt(squares.cast("double") / F.col("total")).alias("tail"))
        out = out.select(*keys, "metric", "total", numbers.alias("s"))
        return out.groupBy(*keys).agg(F.max("total").cast("double").alias(f"{name}_rows"), *[F.max(F.when(F.col("metric") == k, F.col("s"))).alias(f"{name}_{k}") for k in REACH])

    own, lang, every = shape(levels, ["lang", "source"], "own"), shape(by_lang, ["lang"], "lang"), shape(overall, [], "all")
    lang = lang.withColumnRenamed("lang", "of_lang")
    both = own.join(lang, own["lang"].eqNullSafe(lang["of_lang"]), "left").withColumn("_all", every.select(F.struct(*[f"all_{k}" for k in REACH])).scalar())

    def blended(k: str, field: str) -> Column:
        weigh = lambda n: F.col(n) / (F.col(n) + F.lit(float(prior)))
        mine, its, alls = F.col(f"own_{k}.{field}"), F.col(f"lang_{k}.{field}"), F.col(f"_all.all_{k}.{field}")
        upper = weigh("lang_rows") * its + (1 - weigh("lang_rows")) * alls
        return weigh("own_rows") * mine + (1 - weigh("own_rows")) * upper

    def cut(k: str) -> Column:
        q1, q3, tail = (blended(k, field) for field in ("q1", "q3", "tail"))
        return q3 + F.lit(float(SPREAD)) * (q3 - q1) + F.lit(float(REACH[k])) * tail

    return both.select("lang", "source", *[cut(k).alias(k) for k in REACH])


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``_base_failed`` and ``_kept`` to rows with ``lang, source, _m``.

    ``limits`` should be a written table: its true size then lets Spark broadcast it, or join by key if it is large.
    """
    failed = (F.col("_m.c.n_words") < 20) | (100 * F.col("_m.c.n_repeat_words") > 30 * F.col("_m.c.n_words"))
    cut = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.struct(*REACH).alias("_cut"))
    fits = F.lit(True)
    for k, v in _rates("_m").items():
        fits = fits & (v <= F.col(f"_cut.{k}"))
    joined = measured.join(cut, measured["lang"].eqNullSafe(cut["_lang"]) & measured["source"].eqNullSafe(cut["_source"]), "left")
    return joined.select(*measured.columns, failed.alias("_base_failed"), (~failed & F.coalesce(fits, F.lit(False))).alias("_kept"))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, ``base_failed`` and ``kept`` of every document."""
    measured = stage(docs.select("doc_id", "lang", "source", metrics(F.col("text")).alias("_m")))
    judged = judge(measured, stage(cutoffs(sketches(measured))))
    return judged.select(
        "doc_id", "_m.c.n_words", "_m.c.word_chars", "_m.n_symbols", "_m.d.n_dup_lines", "_m.c.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Rows and their metrics are written once and read for both steps."""
    measured = stage(docs.select(F.struct("*").alias("_row"), "lang", "source", metrics(F.col("text")).alias("_m")))
    judged = judge(measured, stage(cutoffs(sketches(measured))))
    return judged.filter("_kept").select("_row.*")
