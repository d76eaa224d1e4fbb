"""Small operators, readers and writers on hand-made tables, and guards for the physical plans."""

import gzip
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from exprspark.functions import scalar as sc
from exprspark.operators import clean, intervals as iv, reads as rd, report
from exprspark.operators.explore import summary_se
from exprspark.sources import readers, writers


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_scalar_functions(spark):
    assert one(spark, sc.strip_version(F.lit("ENSG01.7"))) == "ENSG01"
    assert one(spark, sc.sub_first(F.lit("aXbX"), "X", "-")) == "a-bX"
    assert one(spark, sc.make_names(F.lit("1-a b"))) == "X1.a.b"
    assert one(spark, sc.make_names(F.lit("a-b"))) == "a.b"
    assert one(spark, sc.truncate_label(F.lit("x" * 60))) == "x" * 47 + "..."
    assert one(spark, sc.neg_log10(F.lit(0.0))) == pytest.approx(307.6526555685887)
    assert one(spark, sc.direction(F.lit(0.0))) is None
    assert one(spark, sc.two_way_label(F.lit(0.0))) == "Downregulated"
    assert one(spark, sc.prefix_recode(F.lit("Astro L1 FGFR3"))) == "Astro"
    assert one(spark, sc.sci(F.lit(0.000123))) == "1.23e-04"
    assert one(spark, sc.signed_log10p(F.lit(0.01), F.lit(-2.0))) == pytest.approx(-2)


def test_summary_se_null_modes(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 2.0), ("b", 4.0)], "g string, x double")
    strict = {r["g"]: r for r in summary_se(df, "x", ["g"]).collect()}
    assert strict["a"]["n"] == 3 and strict["a"]["mean"] is None
    loose = {r["g"]: r for r in summary_se(df, "x", ["g"], na_rm=True).collect()}
    assert loose["a"]["n"] == 2 and loose["a"]["mean"] == 2
    assert loose["b"]["ci"] == pytest.approx(12.7062047 * loose["b"]["se"])


def test_capped_and_bounded_lists(spark):
    df = spark.createDataFrame([(f"g{i:02d}", i / 100, min(1.0, i / 20)) for i in range(40)], "feature_id string, p_value double, fdr double")
    order = [F.col("p_value"), F.col("feature_id")]
    assert report.capped_list(df, 3, 0.05, order).count() == 3
    assert report.capped_list(df, 10, 0.05, order).count() == 1
    assert report.bounded_top(df, F.col("fdr") < 0.05, 20, 30, order).count() == 20
    assert report.bounded_top(df, F.col("fdr") < 2, 20, 30, order).count() == 30
    assert report.both_ends(df, 10, order, [F.col("p_value").desc()]).count() == 10
    assert report.both_ends(df, 100, order, [F.col("p_value").desc()]).count() == 40


def test_interleave_needs_equal_lengths():
    assert list(report.interleave({"a": 1, "b": 2}, {"c": 3, "d": 4})) == ["a", "c", "b", "d"]
    with pytest.raises(ValueError):
        report.interleave({"a": 1}, {})


def test_trim_reads_with_errors_and_quality(spark):
    body = "G" * 40
    rows = [("exact", body + "AGATCGGAAGAGCTT", "I" * 55), ("one", body + "AGATCGGTAGAGC", "I" * 53), ("two", body + "AGTTCGGTAGAGC", "I" * 53), ("tail", body + "AGA", "I" * 43), ("end", body, "I" * 36 + "####"), ("dip", body, "I" * 20 + "#" + "I" * 19), ("none", "", "")]
    df = spark.createDataFrame(rows, "read_id string, seq string, qual string")
    got = {r["read_id"]: len(r["seq"]) for r in rd.trim_reads(df, errors=0.1, quality=20, min_length=0).collect()}
    assert got == {"exact": 40, "one": 40, "two": 53, "tail": 40, "end": 36, "dip": 40, "none": 0}
    assert len(rd.TRANSPOSASE_ADAPTER) == 19


def test_trim_reads(spark):
    rows = [("1", "ACGT" * 10 + "AGATCGGAAGAGCTTT", 1), ("2", "ACGT" * 10 + "AGATC", 1), ("3", "ACGT" * 5, 1), ("4", "N" * 10 + "ACGT" * 10, 1)]
    df = spark.createDataFrame([(i, s, "I" * len(s), m) for i, s, m in rows], "read_id string, seq string, qual string, mate int")
    got = {r["read_id"]: r for r in rd.trim_reads(df, min_overlap=3).collect()}
    assert got["1"]["seq"] == "ACGT" * 10 == got["2"]["seq"] and set(got) == {"1", "2"}
    assert len(got["2"]["qual"]) == 40


def test_ambiguous_reads_are_not_assigned(spark):
    feats = spark.createDataFrame([("x", "c", 0, 100), ("y", "c", 80, 200), ("z", "c", 90, 95)], "interval_id string, chrom string, start long, end long")
    reads = spark.createDataFrame([("s", "c", 10, 20), ("s", "c", 10, 20), ("s", "c", 85, 99), ("s", "c", 150, 300), ("s", "c", 300, 310), ("s", "d", 1, 2)],
                                  "sample_id string, chrom string, start long, end long")
    got = {(r["status"], r["interval_id"]): r["n"] for r in iv.count_overlaps(reads, feats).collect()}
    assert got == {("assigned", "x"): 2, ("assigned", "y"): 1, ("ambiguous", None): 1, ("no_feature", None): 2}


def test_averaging_copies_of_one_track_returns_it(spark):
    t = spark.createDataFrame([("c", 0, 10, 0.1), ("c", 10, 15, 0.7), ("c", 30, 40, 3.0)], "chrom string, start long, end long, value double")
    copies = clean.rbind(*[t.withColumn("track", F.lit(str(i))) for i in range(3)])
    got = sorted(tuple(r) for r in iv.average_tracks(copies, tile=4).collect())
    assert got == [("c", 0, 10, pytest.approx(0.1)), ("c", 10, 15, pytest.approx(0.7)), ("c", 30, 40, 3.0)]


def test_fastq_plain_split_anywhere_and_gz(spark, tmp_path):
    recs = "".join(f"@r{i}/1 x\n{'ACGT' * 5}\n+\n@{'I' * 19}\n" for i in range(2000))
    (tmp_path / "s1_R1.fastq").write_text(recs)
    with gzip.open(tmp_path / "s2_R2.fastq.gz", "wt") as f:
        f.write(recs)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        df = readers.read_fastq(spark, str(tmp_path / "*"))
        got = {(r["sample_id"], r["mate"]): r["n"] for r in df.filter("length(seq) = 20 and length(qual) = 20 and qual like '@I%'")
               .groupBy("sample_id", "mate").agg(F.count_distinct("read_id").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {("s1", 1): 2000, ("s2", 2): 2000}


def test_star_files_keep_the_first_genes(spark, tmp_path):
    for s in ("A", "B"):
        with gzip.open(tmp_path / f"{s}ReadsPerGene.out.tab.gz", "wt") as f:
            f.write("N_unmapped\t1\t1\t1\nN_ambiguous\t1\t1\t1\n" + "".join(f"g{i}.1\t{i}\t{2 * i}\t0\n" for i in range(1, 7)))
    m = clean.strip_versions(readers.read_star_counts(spark, str(tmp_path / "*.gz"), "strand1"))
    got = {(r["feature_id"], r["sample_id"]): r["count"] for r in m.collect()}
    assert len(got) == 12 and got["g1", "A"] == 2


def test_report_rows_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "term string, p_value double")
    writers.write_results({"z": empty, "a": empty}, str(tmp_path))
    assert readers.list_results(spark, str(tmp_path)) == ["z", "a"]
    assert tuple(writers.report_rows(readers.read_result(spark, "z", str(tmp_path))).first()) == ("Nothing significant", 0.0)


def test_staged_tables_go_to_the_folder_the_cluster_names(tmp_path):
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "from exprspark import session\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        ".config('spark.checkpoint.dir', sys.argv[2]).getOrCreate()\n"
        "assert session.shared_dir(s) == sys.argv[2]\n"
        "assert session.stage(s.range(3)).count() == 3\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code, root, str(tmp_path)], check=True, capture_output=True, timeout=120)
    assert any(p.name.startswith("staged-") for p in tmp_path.iterdir())


def test_term_filter_and_columns_reach_the_scan(spark):
    from exprspark.plans import inputs
    from support import SF
    df = inputs.table(spark, SF, "part").filter(F.col("p_type").isin("PROMO", "SMALL")).select("p_partkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(p_type" in plan and "p_retailprice" not in plan


def test_overlap_count_has_no_nested_loop(spark):
    feats = spark.createDataFrame([("x", "c", 0, 100)], "interval_id string, chrom string, start long, end long")
    reads = spark.createDataFrame([("s", "c", 10, 20)], "sample_id string, chrom string, start long, end long")
    plan = iv.count_overlaps(reads, feats)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_mitochondrial_genes_are_gone(spark):
    m = spark.createDataFrame([("MT-ND1", "c", 1.0), ("MT-CYB", "c", 1.0), ("ACTB", "c", 2.0)], "feature_id string, cell_id string, count double")
    kept = clean.remove_mitochondrial(m)
    assert clean.features_with_prefix(kept).isEmpty() and kept.count() == 1
    assert len(clean.MITOCHONDRIAL_GENES) == 13


def test_alignment_flags_and_quality_limits(spark):
    rows = [(str(f), "chr1", 20, f) for f in (0, 4, 16, 256, 1024, 2048)] + [("q", "chr1", 19, 0), ("m", "chrM", 60, 0), ("c", "chr1,", 60, 0), ("x", "chrX", 60, 0)]
    df = spark.createDataFrame(rows, "read_id string, chrom string, mapq int, flag int")
    assert {r["read_id"] for r in iv.filter_alignments(df).collect()} == {"0", "16", "x", "c"}  # the pattern is found anywhere in the name
    assert {r["read_id"] for r in iv.filter_alignments(df, remove=iv.REMOVE_FLAGS_KEEP_DUPLICATES).collect()} == {"0", "16", "1024", "x", "c"}


def test_confidence_ties_and_limits(spark):
    from exprspark.operators import cells as cl
    df = spark.createDataFrame([("a", 0.5, 0.1), ("b", 0.9, 0.1), ("c", 0.45, 0.45), ("d", 0.6, 0.4)], "cell_id string, Astro double, Exc double")
    got = cl.confidence_filter(df, ["Astro", "Exc"]).collect()
    assert [(r["cell_id"], r["predicted_id"]) for r in got] == [("b", "Astro")]
