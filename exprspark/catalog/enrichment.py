"""Gene-set queries: over-representation, preranked enrichment, term networks, differential expression."""

from pyspark.sql import functions as F

from exprspark.catalog.registry import cte, query, r
from exprspark.catalog.tables import staged_deg  # noqa: F401  (defines the result-table CTEs)
from exprspark.functions import scalar as sc
from exprspark.operators import de, enrich, explore, gsea, network, normalize, report
from exprspark.operators import hurdle as hurdle_model
from exprspark.operators.ranking import ordered_index
from exprspark.plans import inputs
from exprspark.plans.inputs import table
from exprspark.session import stage

cte("c_sets", """
    SELECT 'brand' AS collection, p_brand AS term_id, CAST(p_partkey AS VARCHAR) AS feature_id FROM part
    UNION ALL SELECT 'type', p_type, CAST(p_partkey AS VARCHAR) FROM part
    UNION ALL SELECT 'type_size', p_type || '_' || CAST((p_size - 1) // 5 AS VARCHAR), CAST(p_partkey AS VARCHAR) FROM part""")


def _ora_ctes(tag: str, fc: str) -> None:
    cte(f"c_query{tag}", f"""
        WITH t AS (SELECT feature_id, log_fc FROM {fc} ORDER BY abs(log_fc) DESC, feature_id LIMIT 200)
        SELECT 'ALL' AS direction, feature_id FROM t UNION ALL SELECT 'UP', feature_id FROM t WHERE log_fc > 0
        UNION ALL SELECT 'DN', feature_id FROM t WHERE log_fc < 0""")
    cte(f"c_counts{tag}", f"""
        WITH z AS (SELECT collection, term_id, count(DISTINCT feature_id) AS m FROM c_sets GROUP BY 1, 2),
        tot AS (SELECT collection, count(DISTINCT feature_id) AS total FROM c_sets GROUP BY 1),
        nn AS (SELECT collection, direction, count(DISTINCT feature_id) AS n FROM c_sets JOIN c_query{tag} USING (feature_id) GROUP BY 1, 2)
        SELECT collection, direction, term_id, m, n, total, count(*) AS k, string_agg(feature_id, '/' ORDER BY feature_id) AS genes
        FROM c_sets JOIN c_query{tag} USING (feature_id) JOIN z USING (collection, term_id) JOIN tot USING (collection) JOIN nn USING (collection, direction)
        GROUP BY 1, 2, 3, 4, 5, 6""")
    cte(f"c_hyper{tag}", f"""
        SELECT collection, direction, term_id, any_value(m) AS m, any_value(n) AS n, any_value(total) AS total, any_value(k) AS k, any_value(genes) AS genes,
               least(1, sum(exp(lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1) + lgamma(total - m + 1) - lgamma(n - i + 1)
                   - lgamma(total - m - n + i + 1) - lgamma(total + 1) + lgamma(n + 1) + lgamma(total - n + 1)) ORDER BY i)) AS p
        FROM (SELECT *, unnest(range(k, least(m, n) + 1)) AS i FROM c_counts{tag}) GROUP BY 1, 2, 3""")
    cte(f"c_ora{tag}", f"""
        WITH a AS (SELECT *, round(p, 12) AS rp FROM c_hyper{tag} WHERE m BETWEEN 10 AND 500),
        b AS (SELECT *, row_number() OVER (PARTITION BY collection, direction ORDER BY rp) AS rk, count(*) OVER (PARTITION BY collection, direction) AS nt,
                     least(1, count(*) FILTER (p > 0.5) OVER (PARTITION BY collection, direction) / (count(*) OVER (PARTITION BY collection, direction) * 0.5)) AS pi0 FROM a),
        c AS (SELECT *, min(least(1, p * nt / rk)) OVER (PARTITION BY collection, direction ORDER BY rk DESC) AS q0 FROM b)
        SELECT *, min(q0) OVER (PARTITION BY collection, direction, rp) AS p_adjust FROM c""")


cte("c_fc2", """
    WITH g AS (
      SELECT CAST(l_partkey AS VARCHAR) AS feature_id, coalesce(avg(l_quantity) FILTER (grp = 'EUROPE'), 0) AS m1,
             coalesce(avg(l_quantity) FILTER (grp = 'ASIA'), 0) AS m0
      FROM lineitem JOIN c_samples ON sample_id = CAST(l_suppkey AS VARCHAR) WHERE grp IN ('ASIA', 'EUROPE') GROUP BY 1)
    SELECT feature_id, round(log2((m1 + 1) / (m0 + 1)), 9) AS log_fc FROM g""")
_ora_ctes("", "c_fc")
_ora_ctes("2", "c_fc2")


def query_lists(spark, d, ref=inputs.REF_GROUP, trt=inputs.TRT_GROUP):
    """ALL, UP and DN lists of the 200 parts with the largest absolute fold change."""
    top = inputs.fold_changes(spark, d, ref, trt).orderBy(F.abs("log_fc").desc(), "feature_id").limit(200)
    return enrich.direction_lists(stage(top.select("feature_id", "log_fc")))


@query("j18_overlap_counts", """
    SELECT collection, direction, term_id, k, m, n, total, genes FROM c_counts""")
def overlap_counts(spark, d):
    c = enrich.overlap_counts(query_lists(spark, d), inputs.gene_sets(spark, d), min_size=1, max_size=None)
    return c.withColumn("genes", F.array_join("genes", "/"))


@query("a20_ora", """
    SELECT collection, direction, term_id, k || '/' || n AS gene_ratio, m || '/' || total AS bg_ratio, round(p, 8) AS p_value,
           round(p_adjust, 8) AS p_adjust, round(p_adjust * nullif(pi0, 0), 8) AS q_value, k AS count, genes FROM c_ora""")
def ora(spark, d):
    t = enrich.ora(query_lists(spark, d), inputs.gene_sets(spark, d))
    return t.select(
        "collection", "direction", "term_id", "gene_ratio", "bg_ratio", r("p_value", 8).alias("p_value"), r("p_adjust", 8).alias("p_adjust"),
        r("q_value", 8).alias("q_value"), "count", F.array_join("genes", "/").alias("genes"))


@query("j11_term_descriptions", """
    SELECT collection, term_id, direction, k AS count, CASE WHEN term_id IN ('PROMO', 'LARGE') THEN 'parts of ' || term_id END AS description FROM c_counts""")
def term_descriptions(spark, d):
    sets = inputs.gene_sets(spark, d)
    c = enrich.overlap_counts(query_lists(spark, d), sets, min_size=1, max_size=None)
    terms = table(spark, d, "part").filter("p_type in ('PROMO', 'LARGE')").select(
        F.col("p_type").alias("term_id"), F.concat(F.lit("parts of "), "p_type").alias("description"))
    return enrich.describe_terms(c, terms).select("collection", "term_id", "direction", F.col("k").alias("count"), "description")


@query("a21_enrich_table", """
    WITH a AS (SELECT *, round(p, 12) AS rp FROM c_hyper WHERE n >= 20),
    b AS (SELECT *, row_number() OVER (PARTITION BY collection, direction ORDER BY rp) AS rk, count(*) OVER (PARTITION BY collection, direction) AS nt FROM a),
    c AS (SELECT *, min(least(1, p * nt / rk)) OVER (PARTITION BY collection, direction ORDER BY rk DESC) AS q0 FROM b),
    h AS (SELECT *, CASE WHEN k = 0 OR m = k OR n = k OR total - n - m + k = 0 THEN 0.5 ELSE 0 END AS h FROM c),
    o AS (SELECT *, (k + h) * (total - n - m + k + h) / ((m - k + h) * (n - k + h)) AS odds FROM h)
    SELECT collection, direction, term_id AS term, k || '/' || m AS overlap, round(p, 8) AS p_value,
           round(min(q0) OVER (PARTITION BY collection, direction, rp), 8) AS adjusted_p_value, round(odds, 6) AS odds_ratio,
           round(-ln(p) * odds, 6) + 0.0 AS combined_score, genes FROM o""")
def enrich_table(spark, d):
    t = enrich.enrich_table(query_lists(spark, d), inputs.gene_sets(spark, d))
    return t.select(
        "collection", "direction", "term", "overlap", r("p_value", 8).alias("p_value"), r("adjusted_p_value", 8).alias("adjusted_p_value"),
        r("odds_ratio").alias("odds_ratio"), (r("combined_score") + 0.0).alias("combined_score"), "genes")


@query("a23_overlap_test", """
    WITH a AS (SELECT DISTINCT feature_id FROM c_query), b AS (SELECT feature_id FROM c_sets WHERE term_id = 'PROMO'),
    t AS (SELECT (SELECT count(*) FROM a WHERE feature_id IN (SELECT * FROM b)) AS w, (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM part) AS n),
    u AS (SELECT w, na - w AS x, nb - w AS y, n - na - nb + w AS z, n FROM t)
    SELECT w AS "both", x AS only_a, y AS only_b, z AS neither,
           round(n * greatest(0, abs(w * z - x * y) - n / 2) * greatest(0, abs(w * z - x * y) - n / 2) / ((w + x) * (y + z) * (w + y) * (x + z)), 8) AS statistic FROM u""")
def overlap_test(spark, d):
    b = inputs.gene_sets(spark, d).filter("term_id = 'PROMO'")
    total = table(spark, d, "part").agg(F.count(F.lit(1))).scalar()
    t = enrich.overlap_test(query_lists(spark, d), b, total)
    return t.withColumn("statistic", r("statistic", 8)).drop("p_value")


@query("j6_compare_enrichment_runs", """
    SELECT coalesce(a.t, b.t) AS term_id, round(-log10(a.p), 6) + 0.0 AS log10p_1, round(-log10(b.p), 6) + 0.0 AS log10p_2
    FROM (SELECT *, collection || '|' || direction || '|' || term_id AS t FROM c_ora) a FULL JOIN (SELECT *, collection || '|' || direction || '|' || term_id AS t FROM c_ora2) b ON a.t = b.t""")
def compare_runs(spark, d):
    runs = [enrich.ora(query_lists(spark, d, *pair), inputs.gene_sets(spark, d)).withColumn("term_id", F.concat_ws("|", "collection", "direction", "term_id"))
            for pair in (("AFRICA", "AMERICA"), ("ASIA", "EUROPE"))]
    t = report.comparison_table(*runs, p="p_value", signed=False)
    return t.select("term_id", (r("log10p_1") + 0.0).alias("log10p_1"), (r("log10p_2") + 0.0).alias("log10p_2"))


@query("p16_p17_figure_rows", """
    SELECT term_id, round(-log10(p), 6) + 0.0 AS log10p, CASE WHEN length(term_id) > 10 THEN left(term_id, 7) || '...' ELSE term_id END AS short_label
    FROM c_ora WHERE direction = 'ALL' AND p <= 0.9 ORDER BY round(p, 9), term_id LIMIT 24""")
def figure_rows(spark, d):
    t = enrich.ora(query_lists(spark, d), inputs.gene_sets(spark, d)).filter("direction = 'ALL'")
    f = report.figure_rows(t, "p_value", "term_id", 24, 0.9, [r("p_value", 9), F.col("term_id")], width=10)
    return f.withColumn("log10p", r("log10p") + 0.0)


NPERM = 1000


def _gsea_ctes(tag: str, where: str, nperm: int) -> None:
    cte(f"c_ranked{tag}", f"SELECT feature_id, log_fc AS score, row_number() OVER (ORDER BY log_fc DESC, feature_id) AS rank FROM c_fc WHERE {where}")
    cte(f"c_running{tag}", f"""
    WITH h AS (SELECT collection, term_id, feature_id, rank, abs(score) AS w FROM c_sets JOIN c_ranked{tag} USING (feature_id)),
    x AS (SELECT *, count(*) OVER t AS m, sum(w) OVER t AS tw, row_number() OVER s AS i, sum(w) OVER s AS cum, (SELECT count(*) FROM c_ranked{tag}) AS n FROM h
          WINDOW t AS (PARTITION BY collection, term_id), s AS (PARTITION BY collection, term_id ORDER BY rank ROWS UNBOUNDED PRECEDING))
    SELECT collection, term_id, feature_id, rank, i, m, n, round(cum / tw - (rank - i) / (n - m), 9) AS after, round((cum - w) / tw - (rank - i) / (n - m), 9) AS before
    FROM x WHERE m BETWEEN 10 AND 500 AND tw > 0""")
    cte(f"c_es{tag}", f"""
    WITH g AS (SELECT collection, term_id, m, n, max(after) AS top, min(before) AS low FROM c_running{tag} GROUP BY 1, 2, 3, 4),
    e AS (SELECT *, CASE WHEN top >= -low THEN top ELSE low END AS es, top >= -low AS up FROM g)
    SELECT e.*, (SELECT min(rank) FROM c_running{tag} x WHERE x.collection = e.collection AND x.term_id = e.term_id AND CASE WHEN up THEN x.after ELSE x.before END = es) AS rank_at_max FROM e""")
    cte(f"c_null{tag}", f"""
    WITH p AS (SELECT perm, rank AS pos, abs(score) AS w, row_number() OVER (PARTITION BY perm ORDER BY substring(md5('1:' || perm || ':' || rank), 1, 16), rank) AS k
               FROM c_ranked{tag}, (SELECT range AS perm FROM range(1, {nperm + 1}))),
    s AS (SELECT DISTINCT m, n FROM c_es{tag}),
    x AS (SELECT m, n, perm, pos, w, row_number() OVER q AS i, sum(w) OVER q AS cum, sum(w) OVER (PARTITION BY m, perm) AS tw FROM p JOIN s ON k <= m
          WINDOW q AS (PARTITION BY m, perm ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    g AS (SELECT m, perm, round(max(cum / tw - (pos - i) / (n - m)), 9) AS top, round(min((cum - w) / tw - (pos - i) / (n - m)), 9) AS low FROM x GROUP BY 1, 2)
    SELECT m, perm, CASE WHEN top >= -low THEN top ELSE low END AS es FROM g""")
    cte(f"c_gsea{tag}", f"""
    WITH j AS (SELECT collection, term_id, e.m, e.es, rank_at_max, count(*) FILTER (abs(u.es) >= abs(e.es)) AS more, count(u.es) AS same, avg(abs(u.es)) AS ma
        FROM c_es{tag} e LEFT JOIN c_null{tag} u ON u.m = e.m AND (u.es >= 0) = (e.es >= 0) GROUP BY 1, 2, 3, 4, 5),
    k AS (SELECT *, (1 + more) / (1 + same) AS p FROM j),
    b AS (SELECT *, least(1, p * count(*) OVER (PARTITION BY collection) / row_number() OVER (PARTITION BY collection ORDER BY p)) AS raw FROM k),
    c AS (SELECT *, min(raw) OVER (PARTITION BY collection ORDER BY p DESC, raw DESC) AS q0 FROM b)
    SELECT *, min(q0) OVER (PARTITION BY collection, p) AS p_adjust FROM c""")


_gsea_ctes("", "true", NPERM)
_gsea_ctes("_up", "log_fc > 0", NPERM)


def ranked(spark, d):
    t = inputs.fold_changes(spark, d).select("feature_id", F.col("log_fc").alias("score"))
    return ordered_index(t, [F.col("score").desc(), F.col("feature_id")])


@query("w3_running_enrichment_score", "SELECT collection, term_id, feature_id, rank, i, after, before FROM c_running")
def running_score(spark, d):
    t = gsea.running_score(ranked(spark, d), inputs.gene_sets(spark, d))
    return t.select("collection", "term_id", "feature_id", "rank", F.col("i").cast("bigint").alias("i"), "after", "before")


@query("a22_gsea", """
    SELECT collection, term_id, m AS set_size, es, round(es / ma, 6) AS nes, round(p, 9) AS p_value, round(p_adjust, 9) AS p_adjust, rank_at_max FROM c_gsea""")
def gsea_all(spark, d):
    t = gsea.gsea(ranked(spark, d), inputs.gene_sets(spark, d), nperm=NPERM)
    return t.select("collection", "term_id", "set_size", "es", r("nes").alias("nes"), r("p_value", 9).alias("p_value"), r("p_adjust", 9).alias("p_adjust"), "rank_at_max")


@query("a22_gsea_core", """
    SELECT x.collection, x.term_id, count(*) AS n_core, string_agg(feature_id, '/' ORDER BY feature_id) AS core_enrichment,
           round(count(*) / any_value(x.m), 9) AS tags, round(CASE WHEN any_value(up) THEN any_value(rank_at_max) ELSE any_value(x.n) - any_value(rank_at_max) + 1 END / any_value(x.n), 9) AS list
    FROM c_running x JOIN c_es e ON x.collection = e.collection AND x.term_id = e.term_id AND CASE WHEN up THEN rank <= rank_at_max ELSE rank >= rank_at_max END GROUP BY 1, 2""")
def gsea_core(spark, d):
    run = gsea.running_score(ranked(spark, d), inputs.gene_sets(spark, d))
    t = gsea.enrichment_scores(run)
    return t.select(
        "collection", "term_id", F.size("core_enrichment").cast("bigint").alias("n_core"),
        F.array_join(F.array_sort("core_enrichment"), "/").alias("core_enrichment"), r("tags", 9).alias("tags"), r("list", 9).alias("list"))


@query("a22_gsea_up_list", """
    SELECT collection, term_id, m AS set_size, es, round(es / ma, 6) AS nes, round(p, 9) AS p_value, round(p_adjust, 9) AS p_adjust, rank_at_max FROM c_gsea_up""")
def gsea_up(spark, d):
    """The same on the list of positive scores only."""
    t = inputs.fold_changes(spark, d)
    up = report.ranked_list(t).filter("list = 'UP'").select("feature_id", "score", "rank")
    t = gsea.gsea(up, inputs.gene_sets(spark, d), nperm=NPERM)
    return t.select("collection", "term_id", "set_size", "es", r("nes").alias("nes"), r("p_value", 9).alias("p_value"), r("p_adjust", 9).alias("p_adjust"), "rank_at_max")


@query("a54_gene_concept_edges", """
    WITH t AS (SELECT collection, term_id, p FROM c_gsea ORDER BY p, term_id LIMIT 5)
    SELECT t.term_id, x.feature_id, log_fc FROM t JOIN c_es e ON e.collection = t.collection AND e.term_id = t.term_id
    JOIN c_running x ON x.collection = e.collection AND x.term_id = e.term_id AND CASE WHEN up THEN x.rank <= rank_at_max ELSE x.rank >= rank_at_max END
    JOIN c_fc f ON f.feature_id = x.feature_id""")
def concept_edges(spark, d):
    t = stage(gsea.gsea(ranked(spark, d), inputs.gene_sets(spark, d), nperm=NPERM))
    return network.gene_concept_edges(t, inputs.fold_changes(spark, d), 5)


cte("c_pairs", """
    WITH s AS (SELECT term_id, count(*) AS sz FROM c_sets GROUP BY 1)
    SELECT a.term_id AS term_1, b.term_id AS term_2, count(*) AS shared, count(*) / (any_value(s1.sz) + any_value(s2.sz) - count(*)) AS jaccard
    FROM c_sets a JOIN c_sets b ON a.feature_id = b.feature_id AND a.term_id < b.term_id JOIN s s1 ON s1.term_id = a.term_id JOIN s s2 ON s2.term_id = b.term_id GROUP BY 1, 2""")


@query("j17_term_similarity", "SELECT term_1, term_2, shared, round(jaccard, 9) AS jaccard FROM c_pairs WHERE jaccard >= 0.03")
def term_similarity(spark, d):
    edges, _ = network.term_similarity(inputs.gene_sets(spark, d), 0.03)
    return edges.withColumn("jaccard", r("jaccard", 9))


@query("a53_similarity_network", """
    WITH RECURSIVE e AS (SELECT term_1 AS a, term_2 AS b FROM c_pairs WHERE jaccard >= 0.07 UNION ALL SELECT term_2, term_1 FROM c_pairs WHERE jaccard >= 0.07),
    reach AS (SELECT DISTINCT term_id AS node, term_id AS seen FROM c_sets UNION SELECT node, b FROM reach JOIN e ON seen = a)
    SELECT node AS term_id, min(seen) AS cluster FROM reach GROUP BY 1""")
def similarity_network(spark, d):
    _, clusters = network.similarity_network(inputs.gene_sets(spark, d), 0.07)
    return clusters


@query("a53_o6_significant_network", """
    WITH t AS (SELECT term_id, row_number() OVER (ORDER BY round(p, 9), term_id) AS place, count(*) FILTER (p < 0.05) OVER () AS sig FROM c_ora WHERE direction = 'ALL'),
    k AS (SELECT term_id FROM t WHERE place <= least(greatest(sig, 20), 100))
    SELECT term_1, term_2, shared, round(jaccard, 9) AS jaccard FROM c_pairs WHERE jaccard >= 0.01 AND term_1 IN (SELECT * FROM k) AND term_2 IN (SELECT * FROM k)""")
def significant_network(spark, d):
    """The network of as many terms as are significant, at least 20 and at most 100."""
    sets = inputs.gene_sets(spark, d)
    t = stage(enrich.ora(query_lists(spark, d), sets).filter("direction = 'ALL'").select("term_id", "p_value"))
    top = report.bounded_top(t, F.col("p_value") < 0.05, 20, 100, [r("p_value", 9), F.col("term_id")])
    edges, _ = network.term_similarity(sets.join(top.select("term_id"), "term_id", "left_semi"), 0.01)
    return edges.withColumn("jaccard", r("jaccard", 9))


@query("a57_simplify_terms", """
    WITH RECURSIVE o AS (SELECT term_id, round(p, 8) AS p, row_number() OVER (ORDER BY round(p, 8), term_id) AS rn FROM c_ora WHERE direction = 'ALL'),
    e AS (SELECT term_1 AS a, term_2 AS b FROM c_pairs WHERE jaccard > 0.05 UNION ALL SELECT term_2, term_1 FROM c_pairs WHERE jaccard > 0.05),
    nb AS (SELECT a, list(b) AS near FROM e GROUP BY 1),
    g AS (SELECT 0 :: BIGINT AS rn, [] :: VARCHAR[] AS kept
          UNION ALL SELECT o.rn, CASE WHEN list_has_any(kept, coalesce(near, [] :: VARCHAR[])) THEN kept ELSE list_append(kept, o.term_id) END
          FROM g JOIN o ON o.rn = g.rn + 1 LEFT JOIN nb ON nb.a = o.term_id)
    SELECT term_id, p AS p_value FROM o WHERE list_contains((SELECT kept FROM g ORDER BY rn DESC LIMIT 1), term_id)""")
def simplify_terms(spark, d):
    sets = inputs.gene_sets(spark, d)
    t = stage(enrich.ora(query_lists(spark, d), sets).filter("direction = 'ALL'").select("term_id", r("p_value", 8).alias("p_value")))
    edges, _ = network.term_similarity(sets, 0.05)
    return enrich.simplify_terms(t, stage(edges), 0.05)


@query("a13_differential_expression")
def differential_expression(spark, d):
    """TMM-scaled NB test of two regions, then the annotated table."""
    from exprspark.catalog.counts import kept_matrix
    from exprspark.operators.clean import annotate
    m = kept_matrix(spark, d)
    lib = stage(normalize.tmm_factors(m))
    t = de.differential_expression(m, lib, inputs.samples(spark, d), inputs.REF_GROUP, inputs.TRT_GROUP)
    return annotate(t, inputs.annotations(spark, d).drop("length"))


cte("c_cells", "SELECT CAST(c_custkey AS VARCHAR) AS cell_id, CAST(c_nationkey AS VARCHAR) AS sample_id, c_mktsegment AS grp FROM customer")
cte("c_cm", """
    SELECT upper(left(p_type, 2)) || '-' || p_size AS feature_id, CAST(o_custkey AS VARCHAR) AS cell_id, sum(l_quantity) AS cnt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")


@query("a30_hurdle_de", """
    WITH c AS (SELECT * FROM c_cells WHERE grp IN ('BUILDING', 'MACHINERY')),
    nc AS (SELECT count(*) FILTER (grp = 'BUILDING') AS n0, count(*) FILTER (grp = 'MACHINERY') AS n1 FROM c),
    x AS (SELECT feature_id, grp = 'MACHINERY' AS t, log2(cnt + 1) AS v FROM c_cm JOIN c USING (cell_id)),
    g AS (SELECT feature_id, count(*) FILTER (NOT t) AS k0, count(*) FILTER (t) AS k1, sum(v * v) AS ss, sum(v) FILTER (NOT t) AS s0, sum(v) FILTER (t) AS s1, n0, n1 FROM x, nc GROUP BY ALL),
    s AS (SELECT feature_id, k0 / n0 AS pct_ref, k1 / n1 AS pct_trt,
      2 * (k0 * ln(k0 / n0) + (n0 - k0) * ln(1 - k0 / n0) + k1 * ln(k1 / n1) + (n1 - k1) * ln(1 - k1 / n1)
         - (k0 + k1) * ln((k0 + k1) / (n0 + n1)) - (n0 + n1 - k0 - k1) * ln(1 - (k0 + k1) / (n0 + n1))) AS lr_d,
      (k0 + k1) * ln((ss - (s0 + s1) * (s0 + s1) / (k0 + k1)) / (ss - s0 * s0 / k0 - s1 * s1 / k1)) AS lr_c,
      s1 / n1 - s0 / n0 AS log_fc,
      1.959963984540054 * sqrt((s1 / k1) * (s1 / k1) * (k1 / n1) * (1 - k1 / n1) / n1 + (s0 / k0) * (s0 / k0) * (k0 / n0) * (1 - k0 / n0) / n0
         + (ss - s0 * s0 / k0 - s1 * s1 / k1) / (k0 + k1 - 2) * ((k1 / n1) * (k1 / n1) / k1 + (k0 / n0) * (k0 / n0) / k0)) AS half FROM g WHERE k0 > 0 AND k1 > 0 AND k0 < n0 AND k1 < n1 AND k0 + k1 > 3)
    SELECT feature_id, round(k0 / n0, 9) AS pct_ref, round(k1 / n1, 9) AS pct_trt, round(lr_d + lr_c, 5) AS statistic, round(exp(-(lr_d + lr_c) / 2), 6) AS p_value,
           round(log_fc, 6) AS log_fc, round(log_fc - half, 5) AS ci_low, round(log_fc + half, 5) AS ci_high, CASE WHEN s.feature_id IS NULL THEN NULL ELSE 2 END AS both_parts FROM g LEFT JOIN s USING (feature_id)""")
def hurdle(spark, d):
    """Detection and level of one feature per part type and size, between two market segments."""
    m = normalize.log2p1(inputs.cell_matrix(spark, d), "count", "value")
    t = hurdle_model.hurdle_de(m, inputs.cells(spark, d), "BUILDING", "MACHINERY", value="value")
    both = F.col("df") == 2  # one part alone has no closed form of its own here: its numbers are checked in the tests
    return t.select(
        "feature_id", r("pct_ref", 9).alias("pct_ref"), r("pct_trt", 9).alias("pct_trt"), F.when(both, r("statistic", 5)).alias("statistic"),
        F.when(both, r("p_value")).alias("p_value"), F.when(both, r("log_fc")).alias("log_fc"), F.when(both, r("ci_low", 5)).alias("ci_low"), F.when(both, r("ci_high", 5)).alias("ci_high"),
        F.when(both, F.col("df")).alias("both_parts"))


@query("a30_hurdle_de_covariate")
def hurdle_covariate(spark, d):
    """The same with a cell's scaled detection rate and the sample's share of the cells of a group as fixed effects."""
    c = inputs.cells(spark, d)
    share = explore.crosstab(c, "sample_id", "group").select("sample_id", "group", "share")
    m = stage(normalize.log2p1(inputs.cell_matrix(spark, d), "count", "value"))
    c = hurdle_model.detection_rate(m, c.filter(F.col("group").isin("BUILDING", "MACHINERY")).join(share, ["sample_id", "group"]), "value")
    return hurdle_model.hurdle_de(m, c, "BUILDING", "MACHINERY", ("detection", "share"), value="value")


@query("a30_pseudobulk_de")
def pseudobulk_de(spark, d):
    """Cells summed to (sample, group) libraries, then the NB test: the sample-level form."""
    c = inputs.cells(spark, d).withColumn("sample_id", F.concat_ws("-", "sample_id", "group"))
    m = stage(de.pseudobulk(inputs.cell_matrix(spark, d), c))
    s = c.select("sample_id", "group").distinct()
    return de.differential_expression(m, stage(normalize.library_size(m)), s, "BUILDING", "MACHINERY")
