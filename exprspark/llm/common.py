"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space between words, and a pattern that finds a word.
SPACE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def explode_once(df: DataFrame, array: Column, *keep: str) -> DataFrame:
    """``keep`` and the fields of each struct in ``array``.

    The outer form is used because for the plain one Spark adds a filter on the array, which would compute it twice.
    """
    return df.select(*keep, F.explode_outer(array).alias("_x")).filter(F.col("_x").isNotNull()).select(*keep, "_x.*")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words between white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def covered(starts: Column, width: int) -> Column:
    """How many positions the runs of ``width`` that begin at the sorted, distinct ``starts`` cover."""
    return let(starts, lambda s: F.aggregate(
        F.transform(s, lambda p, i: F.least(F.lit(width), F.coalesce(p - F.get(s, i - 1), F.lit(width))).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b))
