"""The driver tables as engine inputs: a matrix, samples, annotations, gene sets, intervals, cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.operators.ranking import bh_adjust

REF_GROUP, TRT_GROUP = "AFRICA", "AMERICA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature = part, sample = supplier, count = ordered quantity."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").cast("string").alias("feature_id"),
        F.col("l_suppkey").cast("string").alias("sample_id"),
    ).agg(F.sum("l_quantity").alias("count"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        .select(F.col("s_suppkey").cast("string").alias("sample_id"), F.col("r_name").alias("group"))
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("feature_id"), F.col("p_brand").alias("symbol"),
        F.col("p_type").alias("biotype"), F.col("p_name").alias("description"),
        F.col("p_size").alias("length"),
    )


def gene_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three collections: brands, types, and types split by size decile."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("feature_id"), "p_brand", "p_type",
        F.concat_ws("_", "p_type", F.floor((F.col("p_size") - 1) / 5).cast("string")).alias("type_size"),
    )
    return p.select("feature_id", F.explode(F.create_map(
        F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"),
        F.lit("type_size"), F.col("type_size"),
    )).alias("collection", "term_id")).select("collection", "term_id", "feature_id")


def fold_changes(
    spark: SparkSession, sf_dir: str, ref: str = REF_GROUP, trt: str = TRT_GROUP
) -> DataFrame:
    """A result table per part: log ratio of mean quantities, a likelihood-ratio-like score and p.

    ``p = exp(-lr / 2)`` is the chi-squared tail for two degrees of freedom.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("feature_id"),
        F.col("l_suppkey").cast("string").alias("sample_id"), "l_quantity",
    )
    rows = li.join(samples(spark, sf_dir).filter(F.col("group").isin(ref, trt)), "sample_id")
    is_trt = F.col("group") == trt
    g = rows.groupBy("feature_id").agg(
        F.coalesce(F.avg(F.when(is_trt, F.col("l_quantity"))), F.lit(0.0)).alias("m1"),
        F.coalesce(F.avg(F.when(~is_trt, F.col("l_quantity"))), F.lit(0.0)).alias("m0"),
        F.count(F.lit(1)).alias("n"),
    )
    log_fc = F.round(F.log2((F.col("m1") + 1) / (F.col("m0") + 1)), 9)
    g = g.select("feature_id", log_fc.alias("log_fc"), F.round(F.log2((F.col("m1") + F.col("m0")) / 2 + 1), 9).alias("log_cpm"), "n")
    g = g.withColumn("lr", F.round(F.col("n") * F.col("log_fc") * F.col("log_fc") / 8, 9))
    return g.withColumn("p_value", F.round(F.exp(-F.col("lr") / 2), 12)).drop("n")


def deg(spark: SparkSession, sf_dir: str, ref: str = REF_GROUP, trt: str = TRT_GROUP) -> DataFrame:
    """The annotated result table: ``feature_id, log_fc, log_cpm, lr, p_value, fdr, symbol, ...``."""
    tests = bh_adjust(fold_changes(spark, sf_dir, ref, trt))
    return tests.join(annotations(spark, sf_dir).drop("length"), "feature_id", "left")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom = supplier, start = order key, end = start + quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")).alias("chrom"),
        F.col("l_orderkey").alias("start"),
        (F.col("l_orderkey") + F.col("l_quantity").cast("bigint")).alias("end"),
        F.when(F.col("l_linestatus") == "F", "-").otherwise("+").alias("strand"),
        F.col("l_returnflag").alias("sample_id"),
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("read_id"),
    )


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment records with flags built from the line status, and MAPQ from the line number."""
    li = table(spark, sf_dir, "lineitem")
    flag = (
        F.when(F.col("l_returnflag") == "A", 3).when(F.col("l_returnflag") == "N", 1027).otherwise(259)
        + F.when(F.col("l_linestatus") == "F", 16).otherwise(0)
        + F.when(F.col("l_linenumber") == 7, 4).otherwise(0)
    )
    tlen = (F.col("l_quantity") * F.when(F.col("l_linestatus") == "F", -10).otherwise(10)).cast("int")
    return li.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("read_id"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit("chrM"))
        .otherwise(F.concat(F.lit("chr"), (F.col("l_suppkey") % 10).cast("string"))).alias("chrom"),
        F.col("l_orderkey").alias("start"),
        (F.col("l_orderkey") + F.col("l_quantity").cast("bigint")).alias("end"),
        F.when(F.col("l_linestatus") == "F", "-").otherwise("+").alias("strand"),
        (F.col("l_linenumber") * 10).alias("mapq"), flag.alias("flag"), tlen.alias("tlen"),
        F.col("l_returnflag").alias("sample_id"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells = customers; sample = nation, group = market segment."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("cell_id"),
        F.col("c_nationkey").cast("string").alias("sample_id"),
        F.col("c_mktsegment").alias("group"),
    )


def cell_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse counts: cell = customer, feature = type and size of the ordered parts."""
    li, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    return (
        li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        .groupBy(
            F.concat_ws("-", F.upper(F.substring("p_type", 1, 2)), "p_size").alias("feature_id"),
            F.col("o_custkey").cast("string").alias("cell_id"),
        ).agg(F.sum("l_quantity").alias("count"))
    )


def user_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse counts: cell = user, feature = event type."""
    return table(spark, sf_dir, "events").groupBy(
        F.col("user_id").cast("string").alias("cell_id"), F.col("event_type").alias("feature_id")
    ).agg(F.count(F.lit(1)).cast("double").alias("count"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("cell_id"), F.col("vec_id"),
        F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("string").alias("label"),
    )
