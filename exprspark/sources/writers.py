"""Sinks: named result tables, CSV, stage tables, bedGraph, appended metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOTHING = "Nothing significant"


def write_results(tables: dict[str, DataFrame], base: str) -> None:
    """One parquet table per named analysis, plus an index that keeps the order of the names.

    An empty result stays an empty typed table.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    if tables:
        spark = next(iter(tables.values())).sparkSession
        rows = [(i, name) for i, name in enumerate(tables)]
        spark.createDataFrame(rows, "place int, name string").coalesce(1).write.mode("overwrite").parquet(f"{base}/_tables")


def report_rows(df: DataFrame) -> DataFrame:
    """For reports: an empty table becomes one row that says so, numbers zero."""
    def cell(name, kind):
        if kind == "string":
            return F.lit(NOTHING).alias(name)
        return (F.lit(0) if kind in ("double", "float", "int", "bigint") else F.lit(None)).cast(kind).alias(name)

    note = df.sparkSession.range(1).select(*[cell(n, t) for n, t in df.dtypes])
    empty = df.agg(F.count(F.lit(1))).scalar() == 0
    return df.unionByName(note.filter(empty))


def write_csv_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_stage(df: DataFrame, base: str, name: str, by_sample: bool = True) -> None:
    """State between workflow steps; partitioned by sample so that later steps read what they need."""
    w = df.write.mode("overwrite")
    (w.partitionBy("sample_id") if by_sample else w).parquet(f"{base}/{name}")


def load_stage(spark: SparkSession, base: str, name: str) -> DataFrame:
    t = spark.read.option("recursiveFileLookup", False).parquet(f"{base}/{name}")
    return t.withColumn("sample_id", F.col("sample_id").cast("string")) if "sample_id" in t.columns else t


def write_bedgraph(df: DataFrame, path: str) -> None:
    """Sorted ``chrom, start, end, value`` text: parts in order, rows in order inside each part."""
    t = df.select("chrom", "start", "end", "value")
    t.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.mode("overwrite").option("sep", "\t").csv(path)


def append_metric(df: DataFrame, path: str) -> None:
    """Add the metrics of all samples of a run to a growing table."""
    df.write.mode("append").parquet(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Write a table unless it is there already."""
    df.write.mode("ignore").parquet(path)
