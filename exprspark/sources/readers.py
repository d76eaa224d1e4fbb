"""Readers. Every one is a single scan over a path or glob with a fixed schema; no per-file loop."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from exprspark import schemas
from exprspark.functions.scalar import before_first, clean_sample_name
from exprspark.operators.clean import canonical_chromosomes, drop_summary_rows, strip_versions

FILE = "_metadata.file_path"
STAR_NAME = r"([^/]+?)[._]?(?:ReadsPerGene\.out)?\.tab(?:\.gz)?$"
COUNTS_NAME = r"([^/]+?)(?:\.(?:bam|counts|txt|tsv|summary|gz))+$"
FASTQ_NAME = r"([^/]+?)(?:[._]R?[12])?(?:_001)?\.f(?:ast)?q(?:\.gz)?$"
FASTQ_MATE = r"[._]R?([12])(?:_001)?\.f(?:ast)?q(?:\.gz)?$"


def name_from_path(pattern: str, path: str | Column = FILE) -> Column:
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), pattern, 1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their number in the file (from 0): ``file, line_no, value``, however files are split.

    A split's lines are consecutive ids of one task, so an id minus the split's smallest id is the
    line's place in it, and the lines of earlier splits are added.
    """
    t = spark.read.text(path).select(
        F.col(FILE).alias("file"), F.col("_metadata.file_block_start").alias("_b"), "value",
        F.monotonically_increasing_id().alias("_id"))
    splits = t.groupBy("file", "_b").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("file").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select("file", "_b", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return t.join(splits, ["file", "_b"]).select("file", (F.col("_off") + F.col("_id") - F.col("_first")).alias("line_no"), "value")


def _tsv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    return spark.read.schema(schema).options(sep="\t", **options).csv(path)


def read_star_counts(spark: SparkSession, path: str, column: str = "unstranded", name: str = STAR_NAME) -> DataFrame:
    """Matrix from per-sample gene count files; ``column`` is ``unstranded``, ``strand1`` or ``strand2``."""
    t = read_star_table(spark, path, name)
    return t.filter(F.col(column) > 0).select(
        F.col("gene_id").alias("feature_id"), "sample_id", F.col(column).cast("double").alias("count"))


def read_star_table(spark: SparkSession, path: str, name: str = STAR_NAME) -> DataFrame:
    """All three strand columns, without the summary rows."""
    t = _tsv(spark, path, schemas.STAR_COUNTS)
    return drop_summary_rows(t.select(*t.columns, name_from_path(name).alias("sample_id")))


def read_featurecounts(spark: SparkSession, path: str, name: str = COUNTS_NAME) -> tuple[DataFrame, DataFrame]:
    """Matrix and feature lengths from per-sample featureCounts files."""
    t = _tsv(spark, path, schemas.FEATURECOUNTS, comment="#")
    t = t.select(*t.columns, name_from_path(name).alias("sample_id")).filter("Geneid <> 'Geneid'")
    matrix = t.select(F.col("Geneid").alias("feature_id"), "sample_id", F.col("n").cast("double").alias("count")).filter("count > 0")
    lengths = t.select(F.col("Geneid").alias("feature_id"), F.col("Length").cast("int").alias("length")).distinct()
    return matrix, lengths


def read_featurecounts_matrix(
    spark: SparkSession, path: str, sample_mark: str = "bam", rules: Sequence[tuple[str, str]] = ((r"\.bam$", ""),)
) -> tuple[DataFrame, DataFrame]:
    """Matrix and lengths from one file with a column per sample."""
    t = spark.read.options(sep="\t", header=True, comment="#").csv(path)
    cols = [c for c in t.columns if sample_mark in c]
    long = t.unpivot(["Geneid"], [F.col(f"`{c}`").cast("double").alias(c) for c in cols], "s", "count")
    matrix = long.select(F.col("Geneid").alias("feature_id"), clean_sample_name("s", rules).alias("sample_id"), "count").filter("count > 0")
    return matrix, t.select(F.col("Geneid").alias("feature_id"), F.col("Length").cast("int").alias("length")).distinct()


def read_count_summary(spark: SparkSession, path: str, name: str = COUNTS_NAME) -> DataFrame:
    """``sample_id, status, n`` from per-sample status files."""
    t = _tsv(spark, path, schemas.COUNT_STATUS)
    return t.select(name_from_path(name).alias("sample_id"), "status", F.col("n").cast("long").alias("n")).filter("status <> 'Status'")


def read_count_summary_matrix(spark: SparkSession, path: str, rules: Sequence[tuple[str, str]] = ((r"\.bam$", ""),)) -> DataFrame:
    """``sample_id, status, n`` from one status file with a column per sample."""
    t = spark.read.options(sep="\t", header=True).csv(path)
    cols = [F.col(f"`{c}`").cast("long").alias(c) for c in t.columns if c != "Status"]
    long = t.unpivot(["Status"], cols, "s", "n")
    return long.select(clean_sample_name("s", rules).alias("sample_id"), F.col("Status").alias("status"), "n")


def read_merged_matrix(
    spark: SparkSession, path: str, id_col: str = "gene_id", drop: Sequence[str] = ("transcript_id", "transcript_id(s)"),
    versions: bool = True,
) -> DataFrame:
    """Matrix from a merged table with a column per sample (counts may be fractional)."""
    t = spark.read.options(sep="\t", header=True).csv(path)
    cols = [F.col(f"`{c}`").cast("double").alias(c) for c in t.columns if c != id_col and c not in drop]
    m = t.unpivot([id_col], cols, "sample_id", "count").withColumnRenamed(id_col, "feature_id").filter("count > 0")
    return strip_versions(m) if versions else m


def read_sample_sheet(
    spark: SparkSession, path: str, schema: str | T.StructType, sample: Column, group: Column
) -> DataFrame:
    """Sample annotation whose id and group are derived from columns such as file paths."""
    return spark.read.schema(schema).option("header", True).csv(path).withColumns({"sample_id": sample, "group": group})


def fastq_sample_rules(path_col: str = "fastq_1") -> tuple[Column, Column]:
    """Sample name from a read file path, and the group before its first underscore."""
    s = clean_sample_name(path_col, [(r"(?:[._]R?[12])?(?:_001)?\.f(?:ast)?q(?:\.gz)?$", "")])
    return s, before_first(s)


def read_result(spark: SparkSession, name: str, base: str, columns: Sequence[str] | None = None) -> DataFrame:
    t = spark.read.parquet(f"{base}/{name}")
    return t.select(*columns) if columns else t


def list_results(spark: SparkSession, base: str) -> list[str]:
    """Names of the result tables in the order they were written."""
    return [r["name"] for r in spark.read.parquet(f"{base}/_tables").orderBy("place").collect()]


def load_annotations(
    spark: SparkSession, path: str, allow: Sequence[str] | None = None, biotype: str | None = None
) -> dict[str, DataFrame]:
    """Annotations, lengths (``end - start``) and background lists from a feature table."""
    t = spark.read.schema(schemas.ANNOTATIONS).option("header", True).csv(path)
    t = canonical_chromosomes(t, "chrom", allow)
    if biotype is not None:
        t = t.filter(F.col("biotype") == biotype)
    named = t.filter("symbol is not null and symbol <> '' and description is not null and description <> ''")
    return {
        "annotations": named.select("feature_id", "symbol", "biotype", "description", "entrez_id").distinct(),
        "lengths": t.groupBy("feature_id").agg(F.max((F.col("end") - F.col("start")).cast("int")).alias("length")),
        "background_features": t.select("feature_id").distinct(),
        "background_symbols": named.select("symbol").distinct(),
        "background_entrez": t.filter("entrez_id is not null").select("entrez_id").distinct(),
    }


def load_gene_sets(
    spark: SparkSession, path: str, collections: Sequence[str] | None = None, name: str = r"([^/]+?)\.gmt(?:\.gz)?$"
) -> tuple[DataFrame, DataFrame]:
    """Gene sets and term descriptions from GMT text; the collection comes from the path."""
    t = spark.read.text(path).select(name_from_path(name).alias("collection"), F.split("value", "\t").alias("p"))
    if collections is not None:
        t = t.filter(F.col("collection").isin(list(collections)))
    t = t.filter(F.size("p") >= 2).select("collection", F.col("p")[0].alias("term_id"), F.col("p")[1].alias("description"), "p")
    members = t.select("collection", "term_id", F.explode(F.slice("p", 3, 1 << 30)).alias("feature_id"))
    return members.filter("feature_id <> ''").distinct(), t.select("collection", "term_id", "description").distinct()


def read_10x(spark: SparkSession, path: str, name: str = r"([^/]+)/[^/]+$") -> tuple[DataFrame, DataFrame]:
    """Sparse counts and cells of all sample folders under a glob.

    ``path`` names the folders; each holds ``matrix.mtx``, ``features.tsv`` and ``barcodes.tsv``
    (plain or gzipped).
    """
    files = {"features": "features.tsv*", "barcodes": "barcodes.tsv*", "matrix": "matrix.mtx*"}
    return read_10x_kinds(spark, {k: f"{path}/{f}" for k, f in files.items()}, name)


def read_10x_kinds(spark: SparkSession, paths: dict[str, str], name: str) -> tuple[DataFrame, DataFrame]:
    """The same from one glob per kind of file: one scan each, however many samples there are.

    Rows and columns of the triplets are line numbers of the other two files. Returns ``feature_id,
    cell_id, sample_id, count`` and ``cell_id, sample_id, barcode``; cell ids are ``sample_barcode``.
    """
    def kind(part: str) -> DataFrame:
        t = read_lines(spark, paths[part])
        return t.select(name_from_path(name, "file").alias("sample_id"), "line_no", "value")

    features = kind("features").select("sample_id", (F.col("line_no") + 1).alias("f"), F.split("value", "\t")[0].alias("feature_id"))
    cells = kind("barcodes").select(
        "sample_id", (F.col("line_no") + 1).alias("c"), F.col("value").alias("barcode"), F.concat_ws("_", "sample_id", "value").alias("cell_id"))
    lines = kind("matrix").filter(~F.col("value").startswith("%"))
    size_line = lines.groupBy("sample_id").agg(F.min("line_no").alias("_size"))
    v = F.split("value", r"\s+")
    triplets = lines.join(size_line, "sample_id").filter("line_no > _size").select(
        "sample_id", v[0].cast("long").alias("f"), v[1].cast("long").alias("c"), v[2].cast("double").alias("count"))
    matrix = triplets.join(features, ["sample_id", "f"]).join(cells, ["sample_id", "c"]).select("feature_id", "cell_id", "sample_id", "count")
    return matrix, cells.select("cell_id", "sample_id", "barcode")


def read_alignments(spark: SparkSession, path: str, name: str = r"([^/]+?)\.sam(?:\.gz)?$") -> DataFrame:
    """Alignment records from SAM text; the end is the start plus the reference length of the CIGAR."""
    t = spark.read.text(path).select(name_from_path(name).alias("sample_id"), "value").filter(~F.col("value").startswith("@"))
    p = F.split("value", "\t")
    t = t.select("sample_id", *[p[i].alias(f"_{i}") for i in range(10)])
    length = F.aggregate(
        F.regexp_extract_all("_5", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    flag = F.col("_1").cast("int")
    return t.select(
        "sample_id", F.col("_0").alias("read_id"), F.col("_2").alias("chrom"), (F.col("_3").cast("long") - 1).alias("start"),
        (F.col("_3").cast("long") - 1 + length).alias("end"), F.when(flag.bitwiseAND(F.lit(16)) != 0, "-").otherwise("+").alias("strand"),
        F.col("_4").cast("int").alias("mapq"), flag.alias("flag"), F.col("_8").cast("int").alias("tlen"),
        F.when(F.col("_6") == "=", F.col("_2")).when(F.col("_6") != "*", F.col("_6")).alias("mate_chrom"),
        (F.col("_7").cast("long") - 1).alias("mate_start"), F.col("_9").alias("seq"), F.when(F.col("_5") != "*", F.col("_5")).alias("cigar"))


_INTERVALS = {
    "bed3": schemas.BED3, "bed6": schemas.BED6, "bedgraph": schemas.BEDGRAPH, "narrowpeak": schemas.NARROWPEAK,
    "chromsizes": schemas.CHROMSIZES, "saf": schemas.SAF,
}


def read_intervals(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Interval files; 1-based inclusive SAF becomes half-open, track and header lines are skipped."""
    t = _tsv(spark, path, _INTERVALS[kind], comment="#")
    if kind == "saf":
        return t.filter("start is not null").withColumn("start", F.col("start") - 1)
    return t if kind == "chromsizes" else t.filter("start is not null")


def to_saf(df: DataFrame) -> DataFrame:
    """Half-open intervals as 1-based SAF columns."""
    strand = F.col("strand") if "strand" in df.columns else F.lit(".")
    return df.select(
        F.concat_ws("_", "chrom", "start", "end").alias("GeneID"), F.col("chrom").alias("Chr"),
        (F.col("start") + 1).alias("Start"), F.col("end").alias("End"), strand.alias("Strand"))


def read_cell_metadata(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_signature(spark: SparkSession, path: str, col: str = "symbol") -> DataFrame:
    """One cleaned list of names per file: asterisks removed, empty cells dropped."""
    t = spark.read.schema(f"{col} string").option("header", False).csv(path)
    return t.select(F.trim(F.regexp_replace(col, r"\*", "")).alias(col)).filter(F.col(col).isNotNull() & (F.col(col) != ""))


def read_fastq(spark: SparkSession, path: str, sample: str = FASTQ_NAME, mate: str = FASTQ_MATE) -> DataFrame:
    """Reads ``sample_id, read_id, seq, qual, mate`` from plain or gzipped FASTQ files.

    A gzipped file is one split, so its lines are grouped in fours where they are read. Plain files
    may be split anywhere; their lines are numbered first and grouped by record number. The two
    kinds may be mixed under one path. A file that ends inside a record fails; empty lines at its end do not count.
    """
    text = spark.read.text(path).select(F.col(FILE).alias("file"), "value")

    def group(batches):
        file, rest = None, []

        def close():
            if any(rest):
                raise ValueError(f"{file} ends inside a record")

        for pdf in batches:
            out = []
            for name, part in pdf.groupby("file", sort=False):
                lines = part["value"].tolist()
                if name != file:
                    close()
                    file, rest = name, []
                lines = rest + lines
                whole = len(lines) // 4 * 4
                rest = lines[whole:]
                out.append(pd.DataFrame({
                    "file": name, "head": lines[0:whole:4], "seq": lines[1:whole:4], "qual": lines[3:whole:4]}))
            if out:
                yield pd.concat(out)
        close()

    schema = "file string, head string, seq string, qual string"
    zipped = text.filter(F.col("file").endswith(".gz")).mapInPandas(group, schema)
    plain = read_lines(spark, path).filter(~F.col("file").endswith(".gz"))
    k = F.col("line_no") % 4
    plain = plain.groupBy("file", F.floor(F.col("line_no") / 4).alias("record")).agg(
        F.max(F.when(k == 0, F.col("value"))).alias("head"), F.max(F.when(k == 1, F.col("value"))).alias("seq"),
        F.max(F.when(k == 3, F.col("value"))).alias("qual"), F.count(F.lit(1)).alias("n"), F.max(F.length("value")).alias("longest")).drop("record")
    cut = F.raise_error(F.concat("file", F.lit(" ends inside a record")))
    plain = plain.filter("n = 4 OR longest > 0").select("file", "head", "seq", F.when(F.col("n") == 4, F.col("qual")).otherwise(cut).alias("qual"))
    m = name_from_path(mate, "file")
    both = zipped if path.endswith(".gz") else zipped.unionByName(plain)
    return both.select(
        name_from_path(sample, "file").alias("sample_id"),
        F.regexp_extract("head", r"^@(\S+?)(?:/[12])?(?:\s|$)", 1).alias("read_id"), "seq", "qual",
        F.when(m == "", 1).otherwise(m.cast("int")).alias("mate"))
