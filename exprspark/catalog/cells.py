"""Single-cell queries: QC, shares, markers, residuals, neighbours, clusters."""

from pyspark.sql import functions as F

from exprspark.catalog import enrichment  # noqa: F401  (defines the cell CTEs)
from exprspark.catalog.registry import cte, query, r
from exprspark.operators import cells as cl
from exprspark.operators import communities as communities_of
from exprspark.operators import normalize
from exprspark.plans import inputs
from exprspark.plans.inputs import table
from exprspark.session import stage

cte("c_cmx", "SELECT feature_id, cell_id, cnt, log2(cnt + 1) AS v FROM c_cm")


@query("a26_cell_qc", """
    SELECT cell_id, count(*) AS n_feature, sum(cnt) AS n_count, round(100 * sum(CASE WHEN feature_id LIKE 'ME-%' THEN cnt ELSE 0 END) / sum(cnt), 6) AS percent_mt
    FROM c_cm GROUP BY 1""")
def cell_qc(spark, d):
    return cl.cell_qc(inputs.cell_matrix(spark, d), "^ME-").withColumn("percent_mt", r("percent_mt"))


@query("p22_cell_qc_filter", """
    SELECT cell_id, count(*) AS n_feature FROM c_cm GROUP BY 1 HAVING count(*) > 20 AND count(*) < 60
    AND 100 * sum(CASE WHEN feature_id LIKE 'ME-%' THEN cnt ELSE 0 END) / sum(cnt) < 17.4""")
def cell_qc_filter(spark, d):
    qc = cl.cell_qc(inputs.cell_matrix(spark, d), "^ME-")
    return cl.qc_filter(qc, 20, 60, 17.4).select("cell_id", "n_feature")


CLASSES = ("click", "error", "purchase", "signup", "view")
cte("c_scores", """
    SELECT user_id, event_type, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS s FROM events GROUP BY 1, 2""")


@query("p24_w2_confidence_filter", """
    WITH t AS (SELECT user_id, event_type, s, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, event_type) AS k FROM c_scores),
    u AS (SELECT user_id, max(s) FILTER (k = 1) AS m1, max(s) FILTER (k = 2) AS m2, max(event_type) FILTER (k = 1) AS best FROM t GROUP BY 1)
    SELECT user_id, best AS predicted_id, round(m1, 9) AS max_score, round(m2, 9) AS second_score, round((m1 - m2) / m1, 9) AS margin
    FROM u WHERE m1 > 0.22 AND (m1 - m2) / m1 > 0.05 AND best <> 'error'""")
def confidence_filter(spark, d):
    """Prediction scores = shares of the event types of a user."""
    n = table(spark, d, "events").groupBy("user_id").pivot("event_type", list(CLASSES)).agg(F.count(F.lit(1))).fillna(0)
    total = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    scores = n.select("user_id", *[(F.col(c) / total).alias(c) for c in CLASSES])
    t = cl.confidence_filter(scores, CLASSES, 0.22, 0.05, keep=[c for c in CLASSES if c != "error"])
    return t.select("user_id", "predicted_id", *[r(c, 9).alias(c) for c in ("max_score", "second_score", "margin")])


@query("a27_majority_label", """
    SELECT o_orderpriority AS cluster, o_orderstatus AS label, n, CAST(size AS BIGINT) AS size FROM (
      SELECT o_orderpriority, o_orderstatus, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_orderpriority) AS size,
             row_number() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC, o_orderstatus) AS k FROM orders GROUP BY 1, 2) WHERE k = 1""")
def majority_label(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("cluster"), F.col("o_orderstatus").alias("label"))
    return cl.majority_label(o, "cluster", "label")


@query("a28_pct_expressed", """
    SELECT feature_id, grp AS "group", round(count(*) / any_value(n), 9) AS pct FROM c_cm JOIN c_cells USING (cell_id)
    JOIN (SELECT grp, count(*) AS n FROM c_cells GROUP BY 1) USING (grp) GROUP BY 1, 2""")
def pct_expressed(spark, d):
    return cl.pct_expressed(inputs.cell_matrix(spark, d), inputs.cells(spark, d)).withColumn("pct", r("pct", 9))


@query("a28_expressed_features", """
    WITH p AS (SELECT feature_id, grp, count(*) / any_value(n) AS pct FROM c_cm JOIN c_cells USING (cell_id)
      JOIN (SELECT grp, count(*) AS n FROM c_cells GROUP BY 1) USING (grp) GROUP BY 1, 2)
    SELECT feature_id, round(max(pct), 9) AS max_pct FROM p GROUP BY 1 HAVING max(pct) >= 0.15""")
def expressed_features(spark, d):
    p = cl.pct_expressed(inputs.cell_matrix(spark, d), inputs.cells(spark, d))
    return cl.expressed_in_any(p, 0.15).withColumn("max_pct", r("max_pct", 9))


@query("a29_detection_rate", """
    WITH n AS (SELECT cell_id, count(*) AS n_feature FROM c_cm GROUP BY 1)
    SELECT cell_id, n_feature, round((n_feature - (SELECT avg(n_feature) FROM n)) / (SELECT stddev_samp(n_feature) FROM n), 8) AS detection_rate FROM n""")
def detection_rate(spark, d):
    return cl.detection_rate(inputs.cell_matrix(spark, d)).withColumn("detection_rate", r("detection_rate", 8))


cte("c_markers", """
    WITH nn AS (SELECT count(*) AS n FROM c_cells), sz AS (SELECT grp, count(*) AS n1 FROM c_cells GROUP BY 1),
    f AS (SELECT DISTINCT feature_id FROM c_cmx),
    x AS (SELECT f.feature_id, c.cell_id, c.grp, coalesce(m.v, 0) AS v FROM f CROSS JOIN c_cells c LEFT JOIN c_cmx m ON m.feature_id = f.feature_id AND m.cell_id = c.cell_id),
    k AS (SELECT *, rank() OVER (PARTITION BY feature_id ORDER BY v) + (count(*) OVER (PARTITION BY feature_id, v) - 1) / 2 AS rk, count(*) OVER (PARTITION BY feature_id, v) AS t FROM x),
    a AS (SELECT feature_id, sum(v) AS sall, count(*) FILTER (v > 0) AS nnz, sum(t * t - 1.0) AS ties FROM k GROUP BY 1),
    g AS (SELECT feature_id, grp, sum(rk) AS rs, sum(v) AS s, count(*) FILTER (v > 0) AS kk FROM k GROUP BY 1, 2 HAVING count(*) FILTER (v > 0) > 0)
    SELECT grp AS cluster, feature_id, kk / n1 AS pct_1, (nnz - kk) / (n - n1) AS pct_2, log2(s / n1 + 1) - log2((sall - s) / (n - n1) + 1) AS avg_log2_fc,
           rs - n1 * (n1 + 1) / 2 AS u, (rs - n1 * (n1 + 1) / 2 - n1 * (n - n1) / 2) / sqrt(n1 * (n - n1) / 12 * ((n + 1) - ties / (n * (n - 1.0)))) AS z
    FROM g JOIN a USING (feature_id) JOIN sz USING (grp), nn""")


def markers(spark, d):
    m = normalize.log2p1(inputs.cell_matrix(spark, d), "count", "value")
    c = inputs.cells(spark, d).select("cell_id", F.col("group").alias("cluster"))
    return cl.find_markers(m, c, min_pct=0.1, min_log_fc=0.02)


@query("a31_find_markers", """
    SELECT cluster, feature_id, round(pct_1, 9) AS pct_1, round(pct_2, 9) AS pct_2, round(avg_log2_fc, 7) AS avg_log2_fc, u, round(z, 7) AS z
    FROM c_markers WHERE greatest(pct_1, pct_2) >= 0.1 AND avg_log2_fc >= 0.02""")
def find_markers(spark, d):
    return markers(spark, d).select(
        "cluster", "feature_id", r("pct_1", 9).alias("pct_1"), r("pct_2", 9).alias("pct_2"), r("avg_log2_fc", 7).alias("avg_log2_fc"), "u", r("z", 7).alias("z"))


@query("w4_top_markers", """
    SELECT cluster, feature_id, round(avg_log2_fc, 9) AS avg_log2_fc FROM c_markers WHERE greatest(pct_1, pct_2) >= 0.1 AND avg_log2_fc >= 0.02
    QUALIFY rank() OVER (PARTITION BY cluster ORDER BY round(avg_log2_fc, 9) DESC) <= 20""")
def top_markers(spark, d):
    t = markers(spark, d).withColumn("avg_log2_fc", r("avg_log2_fc", 9))
    return cl.top_markers(t).select("cluster", "feature_id", "avg_log2_fc")


cte("c_ct", """
    SELECT c.sample_id, m.feature_id, m.cell_id, m.cnt FROM c_cm m JOIN c_cells c USING (cell_id)""")
cte("c_res", """
    WITH a AS (SELECT sample_id, cell_id, sum(cnt) AS ctot FROM c_ct GROUP BY 1, 2), f AS (SELECT sample_id, feature_id, sum(cnt) AS ftot FROM c_ct GROUP BY 1, 2),
    s AS (SELECT sample_id, sum(ctot) AS tot, sqrt(count(*)) AS clip FROM a GROUP BY 1),
    x AS (SELECT a.sample_id, f.feature_id, a.cell_id, coalesce(m.cnt, 0) AS cnt, ftot * ctot / tot AS mu, clip, m.cnt IS NOT NULL AS present FROM a JOIN f ON f.sample_id = a.sample_id JOIN s ON s.sample_id = a.sample_id
          LEFT JOIN c_ct m ON m.cell_id = a.cell_id AND m.feature_id = f.feature_id)
    SELECT *, greatest(least((cnt - mu) / sqrt(mu + mu * mu / 100), clip), -clip) AS res, greatest(least((0 - mu) / sqrt(mu + mu * mu / 100), clip), -clip) AS zres FROM x""")


@query("a32_u7_normalize_cells", """
    SELECT sample_id, feature_id, cell_id, round(res, 7) AS residual, round(zres, 7) AS zero_residual FROM c_res WHERE present""")
def normalize_cells(spark, d):
    t = cl.normalize_cells(inputs.cell_matrix(spark, d), inputs.cells(spark, d))
    return t.withColumn("residual", r("residual", 7)).withColumn("zero_residual", r("zero_residual", 7))


cte("c_var", "SELECT sample_id, feature_id, var_samp(res) AS variance FROM c_res GROUP BY 1, 2 HAVING count(*) > 1")


@query("a33_residual_variance", "SELECT sample_id, feature_id, round(variance, 7) AS variance FROM c_var")
def residual_variance(spark, d):
    t = cl.residual_variance(inputs.cell_matrix(spark, d), inputs.cells(spark, d))
    return t.withColumn("variance", r("variance", 7))


@query("a33_select_features", """
    WITH k AS (SELECT feature_id, rank() OVER (PARTITION BY sample_id ORDER BY round(variance, 9) DESC) + (count(*) OVER (PARTITION BY sample_id, round(variance, 9)) - 1) / 2 AS r FROM c_var)
    SELECT feature_id, median(r) AS median_rank, count(*) AS n_samples FROM k WHERE r <= 100 GROUP BY 1 ORDER BY 3 DESC, 2, 1 LIMIT 50""")
def select_features(spark, d):
    t = cl.residual_variance(inputs.cell_matrix(spark, d), inputs.cells(spark, d))
    return cl.select_features(t, 50, top=100)


cte("c_knn", """
    SELECT q.vec_id AS qid, x.vec_id AS rid, x.label, round(list_distance(q.embedding :: DOUBLE[], x.embedding :: DOUBLE[]), 9) AS dist,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_distance(q.embedding :: DOUBLE[], x.embedding :: DOUBLE[]), 9), CAST(x.vec_id AS VARCHAR)) AS place
    FROM embeddings q, embeddings x WHERE q.vec_id % 2 = 1 AND x.vec_id % 2 = 0""")


def ref_and_query(spark, d):
    """Even vectors are the labelled reference, odd ones the query; together the whole table."""
    v = stage(inputs.vectors(spark, d))
    return v.filter("vec_id % 2 = 0"), v.filter("vec_id % 2 = 1")


@query("a34_nearest_neighbours", "SELECT CAST(qid AS VARCHAR) AS query_id, CAST(rid AS VARCHAR) AS ref_id, dist AS distance, CAST(place AS INTEGER) AS place FROM c_knn WHERE place <= 15")
def nearest(spark, d):
    ref, q = ref_and_query(spark, d)
    return cl.knn(q, ref, 15)


@query("a34_transfer_labels", """
    WITH v AS (SELECT qid, label, sum(1 / (1 + dist)) AS w FROM c_knn WHERE place <= 15 GROUP BY 1, 2), s AS (SELECT *, round(w / sum(w) OVER (PARTITION BY qid), 9) AS sc FROM v)
    SELECT CAST(qid AS VARCHAR) AS cell_id, CAST(label AS VARCHAR) AS predicted_id, sc AS max_score FROM s
    QUALIFY row_number() OVER (PARTITION BY qid ORDER BY sc DESC, CAST(label AS VARCHAR)) = 1""")
def transfer(spark, d):
    ref, q = ref_and_query(spark, d)
    return cl.transfer_labels(ref, q, 15).select("cell_id", "predicted_id", "max_score")


@query("a35_integrate_samples")
def integrate(spark, d):
    v = stage(inputs.vectors(spark, d).withColumn("sample_id", (F.col("vec_id") % 2).cast("string")))
    return cl.integrate_samples(v, "sample_id", "0")


@query("a36_cluster_cells")
def cluster(spark, d):
    return cl.cluster_cells(inputs.vectors(spark, d), 10)


@query("a36_neighbour_communities")
def communities(spark, d):
    return cl.neighbour_communities(stage(inputs.vectors(spark, d)))


cte("c_near", """
    WITH d AS (SELECT q.vec_id :: VARCHAR AS a, x.vec_id :: VARCHAR AS b, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_distance(q.embedding :: DOUBLE[], x.embedding :: DOUBLE[]), 9), x.vec_id :: VARCHAR) AS place
        FROM embeddings q, embeddings x)
    SELECT a, b FROM d WHERE place <= 20 UNION SELECT vec_id :: VARCHAR, vec_id :: VARCHAR FROM embeddings""")


@query("a36_shared_neighbours", """
    WITH s AS (SELECT a, list(b) AS s FROM c_near GROUP BY 1), p AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM c_near WHERE a <> b),
    w AS (SELECT p.a, p.b, len(list_intersect(x.s, y.s)) AS n, len(x.s) + len(y.s) AS total FROM p JOIN s x ON x.a = p.a JOIN s y ON y.a = p.b)
    SELECT a, b, CAST(round(n / (total - n) * 1000000) AS BIGINT) AS w FROM w WHERE n / (total - n) > 1 / 15""")
def shared_neighbours(spark, d):
    """The weighted neighbour graph that the communities are found in."""
    return communities_of.shared_neighbours(stage(inputs.vectors(spark, d).select("cell_id", "vec")))


@query("a36_modularity_clusters")
def modularity_clusters(spark, d):
    """Clusters at the default resolution."""
    return communities_of.modularity_clusters(inputs.vectors(spark, d))
