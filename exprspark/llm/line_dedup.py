"""Line dedup by overlapping three-line windows.

Lines with a word are numbered per document. A window is three consecutive ones; its 128-bit hash is looked up
over the whole corpus. The first occurrence in the order (doc_id, text hash, position) stays, every later one
marks its three lines, and marked lines are removed. Windows are judged on the input. Lines without a word are
never part of a window and always stay.

Defined results: a null text stays null; rows that repeat doc_id and text are one document and get the same
result; a null doc_id comes before all others; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.common import HAS_WORD, explode_once, let, same
from exprspark.session import stage

WIDTH = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(text: Column) -> Column:
    """(h1, h2, j) of each window; j numbers the lines that have a word."""
    full = F.filter(_lines(text), lambda x: x.rlike(HAS_WORD))

    def of(x: Column) -> Column:
        parts = lambda j: [F.get(x, j + k) for k in range(WIDTH)]
        return F.transform(
            F.sequence(F.lit(0), F.size(x) - WIDTH),
            lambda j: F.struct(F.xxhash64(*parts(j)).alias("h1"), F.xxhash64(F.lit("second"), *parts(j)).alias("h2"), j.alias("j")))

    return let(full, lambda x: F.when(F.size(x) >= WIDTH, of(x)))


def later_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, starts): where windows begin that occurred before, sorted, one row per document with any."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    windows = stage(explode_once(keyed, _windows(F.col("text")), "doc_id", "text_hash")
                    .select("h1", "h2", F.struct("doc_id", "text_hash", "j").alias("at")))
    # written first: a join of two tables as they are lets Spark split a window that very many documents share
    first = stage(windows.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    return (windows.join(first, ["h1", "h2"]).filter(~F.col("at").eqNullSafe(F.col("first")))
            .groupBy("at.doc_id", "at.text_hash").agg(F.array_sort(F.collect_set("at.j")).alias("starts")))


def _kept(text: Column, starts: Column) -> Column:
    """The lines that stay, as an array."""

    def of(x: Column) -> Column:
        numbered = F.filter(F.transform(x, lambda line, i: F.struct(line.alias("line"), i.alias("i"))), lambda s: s["line"].rlike(HAS_WORD))
        gone = let(numbered, lambda n: F.array_distinct(F.flatten(F.transform(
            starts, lambda p: F.array(*[F.get(n, p + k)["i"] for k in range(WIDTH)])))))
        rest = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone)
        return F.transform(rest, lambda i: F.get(x, i))

    return let(_lines(text), of)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns as ``_row``, the remaining text as ``_text``, ``_n_lines`` and ``_n_removed`` (lines)."""
    marks = later_windows(docs)
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    text = F.col("_row.text")
    joined = rows.join(marks, same(rows, marks, "doc_id", "text_hash"), "left").select("_row", "starts")
    lines = F.when(F.col("starts").isNull(), _lines(text)).otherwise(_kept(text, F.col("starts")))
    n_lines = F.coalesce(F.size(_lines(text)), F.lit(0)).cast("long")
    return joined.select("_row", n_lines.alias("_n_lines"), lines.alias("_lines")).select(
        "_row", "_n_lines", F.when(F.col("_row.text").isNull(), F.lit(0).cast("long")).otherwise(F.col("_n_lines") - F.size("_lines")).alias("_n_removed"),
        F.array_join("_lines", "\n").alias("_text"))


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents with repeated lines removed; ``n_chars`` follows the new text."""
    out = dedup_lines(docs)
    changed = {"text": F.col("_text"), "n_chars": F.when(F.col("_n_removed") > 0, F.length("_text").cast("long")).otherwise(F.col("_row.n_chars"))}
    return out.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
