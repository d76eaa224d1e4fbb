"""Count matrix queries: normalization, filters, sample summaries."""

from pyspark.sql import functions as F

from exprspark.catalog.registry import cte, query, r
from exprspark.operators import normalize as nz
from exprspark.plans import inputs
from exprspark.session import stage

cte("c_matrix", """
    SELECT CAST(l_partkey AS VARCHAR) AS feature_id, CAST(l_suppkey AS VARCHAR) AS sample_id,
           sum(l_quantity) AS cnt FROM lineitem GROUP BY 1, 2""")
cte("c_samples", """
    SELECT CAST(s_suppkey AS VARCHAR) AS sample_id, r_name AS grp
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
cte("c_ann", """
    SELECT CAST(p_partkey AS VARCHAR) AS feature_id, p_brand AS symbol, p_type AS biotype,
           p_name AS description, p_size AS length FROM part""")
cte("c_lib", "SELECT sample_id, sum(cnt) AS lib_size FROM c_matrix GROUP BY 1")
cte("c_cpm", """
    SELECT feature_id, sample_id, cnt, 1e6 * cnt / lib_size AS cpm
    FROM c_matrix JOIN c_lib USING (sample_id)""")
cte("c_kept", "SELECT feature_id FROM c_cpm WHERE cpm > 2000 GROUP BY 1 HAVING count(*) >= 5")
cte("c_km", "SELECT * FROM c_matrix WHERE feature_id IN (SELECT feature_id FROM c_kept)")
cte("c_klib", "SELECT sample_id, sum(cnt) AS lib_size FROM c_km GROUP BY 1")
cte("c_zero", """
    SELECT log2((2 / avg(lib_size)) / (1 + 2 * (2 / avg(lib_size))) * 1e6) AS z, count(*) AS ns FROM c_klib""")
cte("c_logcpm", """
    SELECT feature_id, sample_id,
           log2((cnt + 2 * lib_size / ml) / (lib_size + 2 * (2 * lib_size / ml)) * 1e6) AS log_cpm
    FROM c_km JOIN c_klib USING (sample_id), (SELECT avg(lib_size) AS ml FROM c_klib)""")
cte("c_meanlog", """
    SELECT feature_id, (sum(log_cpm) + (any_value(ns) - count(*)) * any_value(z)) / any_value(ns) AS mean_log_cpm
    FROM c_logcpm, c_zero GROUP BY 1""")
cte("c_grid", """
    SELECT feature_id, sample_id, coalesce(cnt, 0) AS cnt
    FROM (SELECT DISTINCT feature_id FROM c_matrix) CROSS JOIN (SELECT sample_id FROM c_lib)
    LEFT JOIN c_matrix USING (feature_id, sample_id)""")
cte("c_logdense", """
    SELECT feature_id, sample_id, coalesce(log_cpm, z) AS x
    FROM (SELECT feature_id FROM c_kept) CROSS JOIN (SELECT sample_id FROM c_klib) CROSS JOIN c_zero
    LEFT JOIN c_logcpm USING (feature_id, sample_id)""")


def staged_matrix(spark, d):
    """The matrix as a written table, like one read from files, for queries that read it more than once."""
    return stage(inputs.matrix(spark, d))


def kept_matrix(spark, d, min_cpm=2000, min_samples=5):
    """The matrix after the expression filter, staged because libraries are summed again on it."""
    m = staged_matrix(spark, d)
    return stage(nz.expressed_filter(m, nz.library_size(m), min_cpm, min_samples))


@query("a1_library_size", """
    SELECT sample_id, grp AS "group", lib_size FROM c_lib JOIN c_samples USING (sample_id)""")
def library_size(spark, d):
    return nz.library_size(inputs.matrix(spark, d), inputs.samples(spark, d))


@query("a2_mean_expression_extremes", """
    WITH t AS (SELECT feature_id, round(sum(cnt) / (SELECT count(*) FROM c_lib), 6) AS mean_count
               FROM c_matrix GROUP BY 1)
    (SELECT *, 'top' AS "end" FROM t ORDER BY mean_count DESC, feature_id LIMIT 15)
    UNION ALL (SELECT *, 'bottom' AS "end" FROM t ORDER BY mean_count, feature_id LIMIT 15)""")
def mean_expression_extremes(spark, d):
    m = nz.mean_expression(staged_matrix(spark, d)).withColumn("mean_count", r("mean_count"))
    return nz.extremes(m, "mean_count", "feature_id", 15)


@query("a3_cpm", "SELECT feature_id, sample_id, cnt AS count, round(cpm, 6) AS cpm FROM c_cpm")
def cpm(spark, d):
    m = staged_matrix(spark, d)
    return nz.cpm(m, nz.library_size(m)).withColumn("cpm", r("cpm"))


@query("a4_tpm_log2", """
    WITH t AS (SELECT feature_id, sample_id, cnt / length AS rate FROM c_matrix JOIN c_ann USING (feature_id)),
    s AS (SELECT sample_id, sum(rate) AS rs FROM t GROUP BY 1)
    SELECT feature_id, sample_id, round(rate / rs * 1e6, 5) AS tpm, round(log2(rate / rs * 1e6 + 1), 6) AS log2_tpm
    FROM t JOIN s USING (sample_id)""")
def tpm_log2(spark, d):
    t = nz.tpm(staged_matrix(spark, d), inputs.annotations(spark, d).select("feature_id", "length"))
    return nz.log2p1(t, "tpm", "log2_tpm").select(
        "feature_id", "sample_id", r("tpm", 5).alias("tpm"), r("log2_tpm").alias("log2_tpm"))


@query("a5_expressed_filter", """
    SELECT feature_id, sample_id, cnt AS count, lib_size FROM c_km JOIN c_klib USING (sample_id)""")
def expressed_filter(spark, d):
    m = kept_matrix(spark, d)
    return m.join(nz.library_size(m), "sample_id")


cte("c_uq", """
    SELECT sample_id, quantile_cont(cnt, 0.75) / sum(cnt) AS q FROM c_grid GROUP BY 1""")
cte("c_ref", """
    SELECT sample_id AS ref_id FROM c_uq, (SELECT avg(q) AS mq FROM c_uq)
    ORDER BY round(abs(q - mq), 12), sample_id LIMIT 1""")
cte("c_ma", """
    SELECT y.sample_id, round(log2((y.cnt / l.lib_size) / (r.cnt / lr.lib_size)), 10) AS m,
           round((log2(y.cnt / l.lib_size) + log2(r.cnt / lr.lib_size)) / 2, 10) AS a,
           (l.lib_size - y.cnt) / (l.lib_size * y.cnt) + (lr.lib_size - r.cnt) / (lr.lib_size * r.cnt) AS v
    FROM c_matrix y JOIN c_lib l USING (sample_id)
    JOIN c_matrix r ON r.feature_id = y.feature_id AND r.sample_id = (SELECT ref_id FROM c_ref)
    JOIN c_lib lr ON lr.sample_id = r.sample_id""")
cte("c_trim", """
    SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY m) + (count(*) OVER (PARTITION BY sample_id, m) - 1) / 2 AS rm,
           rank() OVER (PARTITION BY sample_id ORDER BY a) + (count(*) OVER (PARTITION BY sample_id, a) - 1) / 2 AS ra,
           count(*) OVER (PARTITION BY sample_id) AS n FROM c_ma""")
cte("c_rawf", """
    SELECT sample_id, CASE WHEN max(abs(m)) < 1e-6 THEN 0 ELSE coalesce(
        sum(m / v) FILTER (rm BETWEEN floor(n * 0.3) + 1 AND n - floor(n * 0.3) AND ra BETWEEN floor(n * 0.05) + 1 AND n - floor(n * 0.05))
        / sum(1 / v) FILTER (rm BETWEEN floor(n * 0.3) + 1 AND n - floor(n * 0.3) AND ra BETWEEN floor(n * 0.05) + 1 AND n - floor(n * 0.05)), 0) END AS lf
    FROM c_trim GROUP BY 1""")
cte("c_tmm", """
    SELECT sample_id, lib_size, pow(2, coalesce(lf, 0) - (SELECT sum(lf) FROM c_rawf) / (SELECT count(*) FROM c_lib)) AS norm_factor
    FROM c_lib LEFT JOIN c_rawf USING (sample_id)""")


@query("a6_tmm_factors", "SELECT sample_id, lib_size, round(norm_factor, 8) AS norm_factor FROM c_tmm")
def tmm_factors(spark, d):
    return nz.tmm_factors(staged_matrix(spark, d)).withColumn("norm_factor", r("norm_factor", 8))


@query("a42_scaling_factors", """
    SELECT sample_id, round(lib_size * norm_factor / 1e6, 10) AS scaling_factor,
           round(1e6 / (lib_size * norm_factor), 6) AS multiplier FROM c_tmm""")
def scaling_factors(spark, d):
    f = nz.scaling_factors(nz.tmm_factors(staged_matrix(spark, d)))
    return f.select("sample_id", r("scaling_factor", 10).alias("scaling_factor"), r("multiplier").alias("multiplier"))


@query("a7_log_cpm", "SELECT feature_id, sample_id, round(log_cpm, 6) AS log_cpm FROM c_logcpm")
def log_cpm(spark, d):
    m = kept_matrix(spark, d)
    return nz.log_cpm(m, nz.library_size(m)).withColumn("log_cpm", r("log_cpm"))


@query("a7_log_cpm_normalized", """
    SELECT feature_id, sample_id,
           round(log2((cnt + 2 * e / me) / (e + 2 * (2 * e / me)) * 1e6), 6) AS log_cpm
    FROM c_matrix JOIN (SELECT sample_id, lib_size * norm_factor AS e FROM c_tmm) USING (sample_id),
         (SELECT avg(lib_size * norm_factor) AS me FROM c_tmm)""")
def log_cpm_normalized(spark, d):
    m = staged_matrix(spark, d)
    return nz.log_cpm(m, stage(nz.tmm_factors(m))).withColumn("log_cpm", r("log_cpm"))


@query("a7_mean_log_cpm", "SELECT feature_id, round(mean_log_cpm, 6) AS mean_log_cpm FROM c_meanlog")
def mean_log_cpm(spark, d):
    m = kept_matrix(spark, d)
    return nz.mean_log_cpm(m, nz.library_size(m)).withColumn("mean_log_cpm", r("mean_log_cpm"))


@query("a8_variance_filter", """
    WITH s AS (SELECT feature_id, round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 9) AS iqr FROM c_logdense GROUP BY 1)
    SELECT feature_id, iqr FROM s WHERE iqr > (SELECT quantile_cont(iqr, 0.75) FROM s)""")
def variance_filter(spark, d):
    m = kept_matrix(spark, d)
    lib = nz.library_size(m)
    n = lib.agg(F.count(F.lit(1))).scalar()
    spread = nz.feature_spread(nz.log_cpm(m, lib), "log_cpm", n, nz.log_cpm_of_zero(lib))
    return nz.variance_filter(spread)


@query("a52_row_zscore", """
    WITH s AS (SELECT feature_id, avg(cnt) AS mu, stddev_samp(cnt) AS sd FROM c_grid GROUP BY 1)
    SELECT feature_id, sample_id, round((cnt - mu) / sd, 6) AS z, round(-mu / sd, 6) AS zero_z
    FROM c_matrix JOIN s USING (feature_id) WHERE sd > 0""")
def row_zscore(spark, d):
    m = staged_matrix(spark, d)
    n = m.agg(F.count_distinct("sample_id")).scalar()
    z = nz.row_zscore(m, "count", n)
    return z.select("feature_id", "sample_id", r("z").alias("z"), r("zero_z").alias("zero_z"))


@query("flagship_mean_log_cpm_top", """
    SELECT feature_id, symbol, biotype, description, round(mean_log_cpm, 6) AS mean_log_cpm
    FROM c_meanlog JOIN c_ann USING (feature_id) ORDER BY round(mean_log_cpm, 6) DESC, feature_id LIMIT 15""")
def flagship_mean_log_cpm_top(spark, d, min_cpm=2000, min_samples=5):
    """Counts to the annotated top features: filter, log CPM, annotation, top 15."""
    m = kept_matrix(spark, d, min_cpm, min_samples)
    e = nz.mean_log_cpm(m, nz.library_size(m)).withColumn("mean_log_cpm", r("mean_log_cpm"))
    return (
        e.join(inputs.annotations(spark, d).drop("length"), "feature_id")
        .orderBy(F.col("mean_log_cpm").desc(), "feature_id").limit(15)
    )
