"""The end-to-end compositions run on the given tables and keep their basic promises."""

from pyspark.sql import functions as F
from support import SF

from exprspark.catalog import coverage as cov
from exprspark.operators import normalize
from exprspark.plans import inputs, workflows
from exprspark.session import stage
from exprspark.sources import readers, writers


def test_bulk_to_enrichment(spark, tmp_path):
    a = inputs.annotations(spark, SF)
    t = workflows.bulk_comparison(
        inputs.matrix(spark, SF), inputs.samples(spark, SF), a.drop("length"), a.select("feature_id", "length"), "AFRICA", "AMERICA")
    writers.write_results({k: t[k] for k in ("all_tests", "DEGs", "class_share", "counts")}, str(tmp_path))
    full = readers.read_result(spark, "all_tests", str(tmp_path))
    assert full.count() == full.select("feature_id").distinct().count() > 0
    assert full.filter("fdr < p_value - 1e-12 or p_value < 0 or p_value > 1").isEmpty()
    terms = spark.createDataFrame([("type", "PROMO", "promoted")], "collection string, term_id string, description string")
    e = workflows.enrichment_tables(full, inputs.gene_sets(spark, SF), terms, p_cut=0.9, p_adj_cut=1.1, nperm=20)
    assert e["GSEA"].count() > 0 and "description" in e["Enrich"].columns


def test_cells(spark):
    v = stage(inputs.vectors(spark, SF))
    ids = inputs.cells(spark, SF)
    out = workflows.label_cells(
        inputs.cell_matrix(spark, SF), ids, v.filter("vec_id % 2 = 1").select("cell_id", "vec"), v.filter("vec_id % 2 = 0"),
        n_clusters=3, k=5, min_feature=1, max_feature=10**6, max_mt=1e9, min_score=0.0)
    cells = out["cells"]
    assert cells.count() == cells.select("cell_id").distinct().count() > 0
    assert out["shares"].groupBy("sample_id").agg(F.sum("share").alias("s")).filter("abs(s - 1) > 1e-9").isEmpty()


def test_coverage_integral_is_the_total_length(spark):
    x = inputs.intervals(spark, SF)
    from exprspark.operators import intervals as iv
    got = iv.coverage(x, ["sample_id", "chrom"], tile=100).agg(F.sum((F.col("end") - F.col("start")) * F.col("value"))).first()[0]
    assert got == x.agg(F.sum(F.col("end") - F.col("start"))).first()[0]
    out = workflows.coverage_and_frip(
        inputs.alignments(spark, SF), cov.features(spark, SF), cov.sizes(spark, SF), chrom=None)
    assert out["frip"].filter("frip between 0 and 1").count() == 1
    assert out["peak_counts"].count() >= 0 and out["coverage"].count() > 0


def test_library_sizes_equal_matrix_total(spark):
    m = inputs.matrix(spark, SF)
    assert normalize.library_size(m).agg(F.sum("lib_size")).first()[0] == m.agg(F.sum("count")).first()[0]
