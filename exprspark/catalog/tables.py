"""Filters, joins, aggregates, top-k and reshapes on the annotated result table and the matrix."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.catalog.registry import cte, query, r
from exprspark.functions import scalar as sc
from exprspark.operators import clean, explore, normalize, report
from exprspark.operators.ranking import bh_adjust, mean_of_ranks
from exprspark.plans import inputs
from exprspark.plans.inputs import table
from exprspark.session import stage

cte("c_fc", """
    WITH g AS (
      SELECT CAST(l_partkey AS VARCHAR) AS feature_id,
             coalesce(avg(l_quantity) FILTER (grp = 'AMERICA'), 0) AS m1,
             coalesce(avg(l_quantity) FILTER (grp = 'AFRICA'), 0) AS m0, count(*) AS n
      FROM lineitem JOIN c_samples ON sample_id = CAST(l_suppkey AS VARCHAR)
      WHERE grp IN ('AFRICA', 'AMERICA') GROUP BY 1),
    f AS (SELECT feature_id, round(log2((m1 + 1) / (m0 + 1)), 9) AS log_fc,
                 round(log2((m1 + m0) / 2 + 1), 9) AS log_cpm, n FROM g),
    l AS (SELECT feature_id, log_fc, log_cpm, round(n * log_fc * log_fc / 8, 9) AS lr FROM f)
    SELECT *, round(exp(-lr / 2), 12) AS p_value FROM l""")
cte("c_bh", """
    SELECT *, min(raw) OVER (ORDER BY p_value DESC, rn DESC) AS fdr FROM (
      SELECT *, least(1, p_value * count(*) OVER () / rn) AS raw FROM (
        SELECT *, row_number() OVER (ORDER BY p_value) AS rn FROM c_fc))""")
cte("c_deg", """
    SELECT feature_id, log_fc, log_cpm, lr, p_value, min(fdr) OVER (PARTITION BY p_value) AS fdr,
           symbol, biotype, description FROM c_bh LEFT JOIN c_ann USING (feature_id)""")


def staged_deg(spark, d):
    return stage(inputs.deg(spark, d))


@query("a14_bh_adjust", "SELECT feature_id, p_value, round(fdr, 9) AS fdr FROM c_deg")
def bh(spark, d):
    t = bh_adjust(inputs.fold_changes(spark, d).select("feature_id", "p_value"))
    return t.withColumn("fdr", r("fdr", 9))


cte("c_bygrp", """
    SELECT *, biotype AS b, row_number() OVER (PARTITION BY biotype ORDER BY p_value) AS rk,
           count(*) OVER (PARTITION BY biotype) AS nb FROM c_deg""")


@query("a14_bh_adjust_by_class", """
    WITH w AS (SELECT *, min(least(1, p_value * nb / rk)) OVER (PARTITION BY b ORDER BY rk DESC) AS q FROM c_bygrp)
    SELECT feature_id, biotype, round(min(q) OVER (PARTITION BY b, p_value), 9) AS fdr FROM w""")
def bh_by_class(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d).select("feature_id", "biotype"), "feature_id")
    return bh_adjust(t, by=["biotype"]).select("feature_id", "biotype", r("fdr", 9).alias("fdr"))


@query("p7_significant_with_fallback", """
    SELECT feature_id, log_fc, p_value FROM c_deg
    WHERE CASE WHEN (SELECT count(*) FROM c_deg WHERE fdr < 0.3) > 15 THEN fdr < 0.3 ELSE p_value < 0.05 END""")
def significant(spark, d):
    return clean.significant(staged_deg(spark, d)).select("feature_id", "log_fc", "p_value")


@query("p7_significant_raw_p", "SELECT feature_id, p_value FROM c_deg WHERE p_value < 0.05")
def significant_raw(spark, d):
    return clean.significant(staged_deg(spark, d), fdr_cut=1e-9, ntable=10**9).select("feature_id", "p_value")


@query("p8_biotype_filter", "SELECT feature_id, symbol FROM c_deg WHERE biotype = 'PROMO' AND symbol IS NOT NULL")
def biotype_filter(spark, d):
    return clean.of_biotype(inputs.annotations(spark, d), "PROMO").join(
        inputs.fold_changes(spark, d), "feature_id", "left_semi").select("feature_id", "symbol")


@query("p9_direction_labels", """
    SELECT feature_id, CASE WHEN log_fc > 0 THEN 'UP' WHEN log_fc < 0 THEN 'DN' END AS direction,
           CASE WHEN log_fc > 0 THEN 'Upregulated' ELSE 'Downregulated' END AS label FROM c_fc""")
def direction_labels(spark, d):
    return inputs.fold_changes(spark, d).select(
        "feature_id", sc.direction("log_fc").alias("direction"), sc.two_way_label("log_fc").alias("label"))


@query("p12_regulation_label", """
    SELECT feature_id, log_fc AS log2_fold_change, round(fdr, 9) AS padj,
           CASE WHEN fdr < 0.3 AND log_fc >= 1 THEN 'Up' WHEN fdr < 0.3 AND log_fc <= -1 THEN 'Down' ELSE 'Normal' END AS regulate
    FROM c_deg""")
def regulation_label(spark, d):
    return inputs.deg(spark, d).select(
        "feature_id", F.col("log_fc").alias("log2_fold_change"), r("fdr", 9).alias("padj"),
        sc.regulation("log_fc", "fdr").alias("regulate"))


@query("p13_volcano_classes", """
    SELECT feature_id, CASE WHEN abs(log_fc) > 0.4 AND p_value < 0.05 THEN 'FC_P' WHEN p_value < 0.05 THEN 'P'
           WHEN abs(log_fc) > 0.4 THEN 'FC' ELSE 'NS' END AS class FROM c_fc""")
def volcano_classes(spark, d):
    return inputs.fold_changes(spark, d).select("feature_id", sc.volcano_class("log_fc", "p_value").alias("class"))


@query("p14_p16_signed_log10p", """
    SELECT feature_id, round(CASE WHEN p_value = 0 THEN -log10(2.2250738585072014e-308) ELSE -log10(p_value) END, 6) AS capped,
           round(coalesce(-log10(nullif(p_value, 0)), (SELECT max(-log10(p_value)) FROM c_fc WHERE p_value > 0)), 6) AS finite_max,
           round(CASE WHEN log_fc > 0 THEN 1 ELSE -1 END * CASE WHEN p_value = 0 THEN -log10(2.2250738585072014e-308) ELSE -log10(p_value) END, 6) AS signed
    FROM c_fc""")
def signed_log10p(spark, d):
    t = stage(inputs.fold_changes(spark, d))
    top = t.filter("p_value > 0").agg(F.max(-F.log10("p_value"))).scalar()
    return t.select(
        "feature_id", r(sc.neg_log10("p_value") + 0.0).alias("capped"),
        r(F.when(F.col("p_value") == 0, top).otherwise(-F.log10("p_value")) + 0.0).alias("finite_max"),
        r(sc.signed_log10p("p_value", "log_fc") + 0.0).alias("signed"))


@query("p15_report_format", """
    SELECT feature_id, round_even(log_fc, 2) AS log_fc, printf('%.2e', p_value) AS p_value FROM c_fc""")
def report_format(spark, d):
    return report.format_deg(inputs.fold_changes(spark, d).select("feature_id", "log_fc", "p_value"))


@query("p17_truncate_label", """
    SELECT p_partkey, CASE WHEN length(p_name) > 9 THEN left(p_name, 6) || '...' ELSE p_name END AS label FROM part""")
def truncate(spark, d):
    return table(spark, d, "part").select("p_partkey", sc.truncate_label("p_name", 9).alias("label"))


@query("p2_strip_version", """
    SELECT CAST(l_partkey // 10 AS VARCHAR) AS feature_id, CAST(l_suppkey AS VARCHAR) AS sample_id,
           sum(l_quantity) AS count FROM lineitem GROUP BY 1, 2""")
def strip_version(spark, d):
    """Ids get a version, so that ten of them become one feature."""
    versioned = inputs.matrix(spark, d).withColumn(
        "feature_id", F.expr("concat(cast(cast(feature_id as bigint) div 10 as string), '.', right(feature_id, 1))"))
    return clean.strip_versions(versioned)


@query("p3_clean_sample_names", """
    SELECT page_id, regexp_replace(regexp_replace(split_part(url, '/', -1), '\\?.*$', ''), '[0-9]', 'N') AS name,
           'X' || regexp_replace(CAST(page_id AS VARCHAR) || '-a b', '[^A-Za-z0-9._]', '.', 'g') AS syntactic FROM pages""")
def clean_names(spark, d):
    return table(spark, d, "pages").select(
        "page_id", sc.clean_sample_name("url", [(r"\?.*$", ""), ("[0-9]", "N")]).alias("name"),
        sc.make_names(F.concat(F.col("page_id").cast("string"), F.lit("-a b"))).alias("syntactic"))


@query("p4_p5_annotation_cleanup", """
    SELECT DISTINCT p_brand AS symbol, p_type AS biotype, p_name AS description FROM part
    WHERE p_name NOT LIKE '%\\_%' ESCAPE '\\' AND p_type IN ('PROMO', 'LARGE') AND p_brand <> '' AND p_name <> ''""")
def annotation_cleanup(spark, d):
    a = inputs.annotations(spark, d).select("symbol", "biotype", "description")
    a = clean.canonical_chromosomes(clean.canonical_chromosomes(a, "description"), "biotype", ["PROMO", "LARGE"])
    return clean.clean_annotations(a)


@query("p6_subset_samples", """
    SELECT feature_id, sample_id, cnt AS count FROM c_matrix JOIN c_samples USING (sample_id)
    WHERE grp IN ('AFRICA', 'ASIA') AND regexp_matches(grp, '^A') AND sample_id NOT IN ('1', '2')""")
def subset_samples(spark, d):
    s = clean.subset_samples(inputs.samples(spark, d), ["AFRICA", "ASIA"], "^A", ["1", "2"])
    return clean.subset_matrix(inputs.matrix(spark, d), s).select("feature_id", "sample_id", "count")


@query("p10_p11_complete_columns", """
    SELECT feature_id, log_fc AS effect FROM c_fc WHERE nullif(log_fc, 0) IS NOT NULL""")
def complete_columns(spark, d):
    t = inputs.fold_changes(spark, d).withColumn("log2_ratio", F.nullif("log_fc", F.lit(0.0)))
    t = clean.select_matching(clean.drop_matching(t, "^log_"), "log2", keep=["feature_id"], rename="effect")
    return clean.complete_cases(t)


@query("p18_p19_recode", """
    SELECT p_partkey, CASE WHEN p_type LIKE 'S%' THEN 'S' WHEN p_type LIKE 'PRO%' THEN 'PRO' ELSE p_type END AS recoded,
           coalesce(r_name, p_type) AS relabelled
    FROM part LEFT JOIN (SELECT r_name, ['ECONOMY', 'PROMO', 'LARGE', 'X', 'Y'][r_regionkey + 1] AS k FROM region) ON k = p_type""")
def recode(spark, d):
    keys = F.array(*[F.lit(x) for x in ("ECONOMY", "PROMO", "LARGE", "X", "Y")])
    m = table(spark, d, "region").select(F.element_at(keys, F.col("r_regionkey") + 1).alias("k"), "r_name")
    p = table(spark, d, "part")
    return clean.relabel(p, m, "p_type", "k", "r_name", "relabelled").select(
        "p_partkey", sc.prefix_recode("p_type", ["S", "PRO"]).alias("recoded"), "relabelled")


@query("p20_p34_name_parts", """
    SELECT s_suppkey, substring(s_name, 10, 6) AS suffix, split_part(s_name, '#', 1) AS head FROM supplier""")
def name_parts(spark, d):
    return table(spark, d, "supplier").select(
        "s_suppkey", F.substring("s_name", 10, 6).alias("suffix"), sc.before_first("s_name", "#").alias("head"))


@query("p21_p23_feature_removal", """
    SELECT feature_id, sum(cnt) AS total FROM c_matrix
    WHERE feature_id NOT IN (SELECT feature_id FROM c_ann WHERE biotype = 'SMALL') GROUP BY 1 HAVING sum(cnt) > 0""")
def feature_removal(spark, d):
    m = inputs.matrix(spark, d)
    kept = clean.remove_features(m, inputs.annotations(spark, d).filter("biotype = 'SMALL'"))
    return clean.restrict_to(kept, clean.nonzero_features(kept), "feature_id").groupBy("feature_id").agg(
        F.sum("count").alias("total"))


@query("p27_design_coding", """
    SELECT sample_id, 1.0::DOUBLE AS intercept, CASE WHEN grp = 'AMERICA' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS trt
    FROM c_samples WHERE grp IN ('AFRICA', 'AMERICA')""")
def design_coding(spark, d):
    from exprspark.operators.de import design
    return design(inputs.samples(spark, d), "AFRICA", "AMERICA").select("sample_id", "intercept", "trt")


@query("p28_u1_negate_append", """
    SELECT feature_id, log_fc FROM c_fc WHERE log_fc > 1 UNION ALL SELECT feature_id, -log_fc FROM c_fc WHERE log_fc < -1""")
def negate_append(spark, d):
    t = inputs.fold_changes(spark, d).select("feature_id", "log_fc")
    return clean.negate_and_append(t.filter("log_fc > 1"), t.filter("log_fc < -1"), "log_fc")


@query("p29_sparse_labels", """
    SELECT feature_id, CASE WHEN symbol IN ('Brand#1', 'Brand#2') THEN symbol END AS label FROM c_ann""")
def sparse_labels(spark, d):
    return inputs.annotations(spark, d).select("feature_id", sc.sparse_label("symbol", ["Brand#1", "Brand#2"]).alias("label"))


@query("p30_symbol_correction", """
    SELECT feature_id, 'NATION_' || CAST(substring(symbol, 7) AS INTEGER) AS symbol FROM c_ann
    WHERE CAST(substring(symbol, 7) AS INTEGER) < 25""")
def symbol_correction(spark, d):
    alias = table(spark, d, "nation").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("alias"), F.col("n_name").alias("approved"))
    return clean.correct_symbols(inputs.annotations(spark, d), alias).select("feature_id", "symbol")


@query("p36_named_terms", "SELECT 'type' AS collection, p_type AS term_id, CAST(p_partkey AS VARCHAR) AS feature_id FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def named_terms(spark, d):
    return inputs.gene_sets(spark, d).filter(F.col("term_id").isin("PROMO", "SMALL"))


@query("j3_annotated_values", """
    SELECT DISTINCT feature_id, sample_id, cnt AS count, symbol, biotype FROM c_matrix JOIN c_ann USING (feature_id)""")
def annotated_values(spark, d):
    a = inputs.annotations(spark, d).select("feature_id", "symbol", "biotype")
    return clean.with_annotations(inputs.matrix(spark, d), a).select("feature_id", "sample_id", "count", "symbol", "biotype")


@query("j4_annotate_by_symbol", """
    SELECT n_name AS feature_id, n_regionkey AS region, p_name AS description, p_type AS biotype
    FROM nation LEFT JOIN part ON 'NATION_' || substring(p_brand, 7) = n_name""")
def annotate_by_symbol(spark, d):
    a = inputs.annotations(spark, d).select(
        F.concat(F.lit("NATION_"), F.substring("symbol", 7, 9)).alias("feature_id"), "description", "biotype")
    n = table(spark, d, "nation").select(F.col("n_name").alias("feature_id"), F.col("n_regionkey").alias("region"))
    return clean.annotate(n, a)


@query("j4_annotate_first", """
    SELECT n_name AS feature_id, n_regionkey AS region, description, biotype FROM nation LEFT JOIN (
      SELECT n, t.d AS description, t.b AS biotype FROM (
        SELECT 'NATION_' || substring(p_brand, 7) AS n, min({'d': p_name, 'b': p_type}) AS t FROM part GROUP BY 1)) ON n = n_name""")
def annotate_first(spark, d):
    a = inputs.annotations(spark, d).select(
        F.concat(F.lit("NATION_"), F.substring("symbol", 7, 9)).alias("feature_id"), "description", "biotype")
    n = table(spark, d, "nation").select(F.col("n_name").alias("feature_id"), F.col("n_regionkey").alias("region"))
    return clean.annotate_first(n, a, order="description")


@query("j7_j10_id_mapping", """
    SELECT CAST(c_custkey AS VARCHAR) AS symbol, CAST(o_orderkey AS VARCHAR) AS entrez_id FROM customer JOIN orders ON o_custkey = c_custkey
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def id_mapping(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    m = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"), F.col("o_orderkey").cast("string").alias("entrez_id"))
    lost = clean.unmapped(ids, m, "symbol", "entrez_id").withColumn("entrez_id", F.lit(None).cast("string"))
    return clean.map_ids(ids, m, "symbol", "entrez_id").unionByName(lost)


@query("j5_j6_full_join_compare", """
    SELECT coalesce(a.term_id, b.term_id) AS term_id, n_1, n_2 FROM
      (SELECT symbol AS term_id, count(*) AS n_1 FROM c_deg WHERE log_fc > 2 GROUP BY 1) a FULL JOIN
      (SELECT symbol AS term_id, count(*) AS n_2 FROM c_deg WHERE log_fc < -2 GROUP BY 1) b ON a.term_id = b.term_id""")
def full_join_compare(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d).select("feature_id", F.col("symbol").alias("term_id")), "feature_id")
    up = t.filter("log_fc > 2").groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    dn = t.filter("log_fc < -2").groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    return clean.compare_tables(up, dn, "term_id")


@query("j8_j13_attach_and_order", """
    SELECT sample_id, grp AS "group", acctbal, n FROM c_samples JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS sample_id, s_acctbal AS acctbal FROM supplier) USING (sample_id)
    LEFT JOIN (SELECT sample_id, count(*) AS n FROM c_matrix GROUP BY 1) USING (sample_id)""")
def attach_and_order(spark, d):
    extra = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("sample_id"), F.col("s_acctbal").alias("acctbal"))
    n = inputs.matrix(spark, d).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    return clean.attach(clean.reorder_like(inputs.samples(spark, d), extra, "sample_id", "acctbal"), n, "sample_id")


@query("u2_u3_u4_set_operations", """
    WITH a AS (SELECT l_partkey AS id FROM lineitem WHERE l_quantity > 49), b AS (SELECT l_partkey AS id FROM lineitem WHERE l_discount = 0)
    SELECT 'union' AS op, count(*) AS n FROM (SELECT id FROM a UNION SELECT id FROM b)
    UNION ALL SELECT 'intersect', count(*) FROM (SELECT id FROM a INTERSECT SELECT id FROM b)
    UNION ALL SELECT 'difference', count(*) FROM (SELECT id FROM a EXCEPT SELECT id FROM b)""")
def set_operations(spark, d):
    li = table(spark, d, "lineitem")
    a = li.filter("l_quantity > 49").select(F.col("l_partkey").alias("id"))
    b = li.filter("l_discount = 0").select(F.col("l_partkey").alias("id"))
    named = (("union", a.union(b).distinct()), ("intersect", a.intersect(b)), ("difference", a.subtract(b)))
    return clean.rbind(*[x.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n") for name, x in named])


@query("u6_merge_samples", """
    SELECT CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) AS cell_id, CAST(c_nationkey AS VARCHAR) AS sample_id FROM customer""")
def merge_samples(spark, d):
    from exprspark.operators.cells import merge_samples as merge
    c = inputs.cells(spark, d).select(F.col("cell_id").alias("barcode"), "sample_id")
    return merge([c.filter("sample_id < '2'"), c.filter("sample_id >= '2'")])


@query("a11_j5_class_share", """
    SELECT biotype, round(100.0 * count(*) FILTER (log_fc > 0) / (SELECT count(*) FROM c_deg WHERE log_fc > 0 AND biotype IS NOT NULL), 6) AS freq_up,
           round(100.0 * count(*) FILTER (log_fc < 0) / (SELECT count(*) FROM c_deg WHERE log_fc < 0 AND biotype IS NOT NULL), 6) AS freq_dn
    FROM c_deg WHERE biotype IS NOT NULL GROUP BY 1""")
def class_share(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d), "feature_id")
    return explore.class_share(stage(t.select("log_fc", "biotype"))).select("biotype", r("freq_up").alias("freq_up"), r("freq_dn").alias("freq_dn"))


@query("a12_deg_counts", """
    SELECT count(*) AS total, count(*) FILTER (log_fc > 0) AS up, count(*) FILTER (log_fc < 0) AS down FROM c_fc""")
def deg_counts(spark, d):
    return explore.deg_counts(inputs.fold_changes(spark, d))


@query("a15_summary_se", """
    SELECT l_shipmode AS g, n, mean, sd, se FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, count(*) AS n, round(avg(l_extendedprice), 5) AS mean,
      round(stddev_samp(l_extendedprice), 5) AS sd, round(stddev_samp(l_extendedprice) / sqrt(count(*)), 6) AS se FROM lineitem GROUP BY 1)""")
def summary_se(spark, d):
    t = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("g"), "l_extendedprice")
    s = explore.summary_se(t, "l_extendedprice", ["g"])
    return s.select("g", "n", r("mean", 5).alias("mean"), r("sd", 5).alias("sd"), r("se").alias("se"))


@query("a15_summary_se_with_interval", """
    WITH g AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS sd, count(*) - 1 AS f, 1.959963984540054 AS z FROM lineitem WHERE l_quantity > 1 GROUP BY 1),
    t AS (SELECT *, z + (z**3 + z) / (4 * f) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * f**2) + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * f**3) AS q FROM g)
    SELECT l_returnflag, n, round(mean, 5) AS mean, round(sd, 5) AS sd, round(sd / sqrt(n), 6) AS se, round(q * sd / sqrt(n), 5) AS ci FROM t""")
def summary_se_interval(spark, d):
    """The SQL has the t quantile's expansion in the degrees of freedom, exact enough for groups of hundreds."""
    t = table(spark, d, "lineitem").withColumn("x", F.when(F.col("l_quantity") > 1, F.col("l_extendedprice")))
    s = explore.summary_se(t, "x", ["l_returnflag"], na_rm=True)
    return s.select("l_returnflag", "n", r("mean", 5).alias("mean"), r("sd", 5).alias("sd"), r("se").alias("se"), r("ci", 5).alias("ci"))


@query("a16_collapse_mean", "SELECT symbol, round(avg(log_fc), 6) AS log_fc FROM c_deg GROUP BY 1")
def collapse_mean(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d), "feature_id")
    return explore.collapse_mean(t, "symbol", "log_fc").withColumn("log_fc", r("log_fc"))


@query("a17_collapse_max_mean", """
    WITH t AS (SELECT feature_id, symbol, sum(cnt) AS s FROM c_matrix JOIN c_ann USING (feature_id) GROUP BY 1, 2),
    b AS (SELECT feature_id, symbol FROM t QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY s DESC, feature_id) = 1)
    SELECT symbol, feature_id, sample_id, cnt AS count FROM c_matrix JOIN b USING (feature_id)""")
def collapse_max_mean(spark, d):
    m = stage(inputs.matrix(spark, d))
    return explore.collapse_max_mean(m, inputs.annotations(spark, d)).select("symbol", "feature_id", "sample_id", "count")


@query("a18_first_per_group", """
    SELECT symbol, biotype, feature_id FROM c_ann QUALIFY row_number() OVER (PARTITION BY symbol, biotype ORDER BY length DESC, feature_id) = 1""")
def first_per_group(spark, d):
    a = inputs.annotations(spark, d).select("symbol", "biotype", "feature_id", "length")
    return explore.first_per_group(a, ["symbol", "biotype"], [-F.col("length"), F.col("feature_id")]).drop("length")


@query("a18_max_abs_per_group", """
    SELECT symbol, feature_id, log_fc FROM c_deg QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY abs(log_fc) DESC, feature_id) = 1""")
def max_abs_per_group(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d), "feature_id").select("symbol", "feature_id", "log_fc")
    return explore.max_abs_per_group(t, "symbol", "log_fc", "feature_id")


cte("c_lists", "SELECT l_orderkey AS term_id, string_agg(CAST(l_partkey AS VARCHAR), ';' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS genes FROM lineitem GROUP BY 1")


def order_lists(spark, d):
    """Delimited lists: the part keys of an order in line order."""
    g = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("term_id")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").cast("string").alias("p")))).alias("a"))
    return g.select("term_id", F.array_join("a.p", ";").alias("genes"))


@query("a19_sorted_list", """
    SELECT l_orderkey AS term_id, string_agg(CAST(l_partkey AS VARCHAR), '/' ORDER BY CAST(l_partkey AS VARCHAR)) AS genes FROM lineitem GROUP BY 1""")
def sorted_list(spark, d):
    return order_lists(spark, d).withColumn("genes", sc.sorted_list("genes", ";"))


@query("r3_split_rows", "SELECT l_orderkey AS term_id, CAST(l_partkey AS VARCHAR) AS gene FROM lineitem")
def split_rows(spark, d):
    return clean.split_rows(order_lists(spark, d), "genes", ";", "gene")


@query("f_ids_to_symbols", """
    SELECT l_orderkey AS term_id, string_agg(coalesce(s, CAST(l_partkey AS VARCHAR)), '/' ORDER BY coalesce(s, CAST(l_partkey AS VARCHAR))) AS symbols
    FROM lineitem LEFT JOIN (SELECT p_partkey AS k, p_brand AS s FROM part WHERE p_size > 25) ON k = l_partkey GROUP BY 1""")
def ids_to_symbols(spark, d):
    m = table(spark, d, "part").filter("p_size > 25").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("symbol"))
    return clean.ids_to_symbols(order_lists(spark, d), "genes", m, "term_id", sep=";").select(
        "term_id", F.translate("symbols", ";", "/").alias("symbols"))


@query("f_ids_to_symbols_top", """
    SELECT term_id, CASE WHEN rn <= 24 THEN s ELSE genes END AS symbols FROM (
      SELECT term_id, genes, row_number() OVER (ORDER BY term_id) AS rn FROM c_lists) JOIN (
      SELECT l_orderkey AS term_id, string_agg(p_brand, ';' ORDER BY p_brand) AS s FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) USING (term_id)""")
def ids_to_symbols_top(spark, d):
    m = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("symbol"))
    t = clean.ids_to_symbols(order_lists(spark, d), "genes", m, "term_id", [F.col("term_id")], ntop=24, keep_unmapped=False, sep=";")
    return t.select("term_id", "symbols")


@query("a24_venn_counts", """
    WITH s AS (SELECT l_partkey, max(CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END) + 2 * max(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END)
        + 4 * max(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS mask FROM lineitem GROUP BY 1)
    SELECT mask, count(*) AS n FROM s WHERE mask > 0 GROUP BY 1""")
def venn_counts(spark, d):
    ids = F.array_compact(F.array(
        F.when(F.col("l_quantity") == 50, 0), F.when(F.col("l_discount") == 0, 1), F.when(F.col("l_tax") == 0, 2)))
    s = table(spark, d, "lineitem").select(F.col("l_partkey").alias("feature_id"), F.explode(ids).alias("set_id"))
    return explore.venn_counts(s)


@query("a25_w7_crosstab", """
    SELECT o_orderpriority AS sample_id, o_orderstatus AS class, count(*) AS n,
           round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 9) AS share FROM orders GROUP BY 1, 2""")
def crosstab(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("sample_id"), F.col("o_orderstatus").alias("class"))
    return explore.crosstab(o, "sample_id", "class").withColumn("share", r("share", 9))


@query("a38_read_status", """
    SELECT l_returnflag AS sample_id, l_linestatus AS status, sum(l_quantity) AS n,
           round(sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_returnflag), 9) AS share FROM lineitem GROUP BY 1, 2""")
def read_status(spark, d):
    s = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("sample_id"), F.col("l_linestatus").alias("status"), F.col("l_quantity").alias("n"))
    return explore.status_summary(s).withColumn("share", r("share", 9))


@query("a49_five_numbers", """
    SELECT feature_id, grp AS "group", round(min(cnt), 6) AS min, round(quantile_cont(cnt, 0.25), 6) AS q1, round(median(cnt), 6) AS median,
           round(quantile_cont(cnt, 0.75), 6) AS q3, round(max(cnt), 6) AS max, count(*) AS n
    FROM c_matrix JOIN c_samples USING (sample_id) GROUP BY 1, 2""")
def five_numbers(spark, d):
    t = inputs.matrix(spark, d).join(inputs.samples(spark, d), "sample_id")
    f = explore.five_numbers(t, "count", ["feature_id", "group"])
    return f.select("feature_id", "group", *[r(c).alias(c) for c in ("min", "q1", "median", "q3", "max")], "n")


@query("a50_histogram", """
    SELECT biotype, least(CAST(floor((log_fc + 6) / 0.5) AS INTEGER) + 1, 24) AS bin, count(*) AS n
    FROM c_deg WHERE log_fc BETWEEN -6 AND 6 GROUP BY 1, 2""")
def histogram(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d), "feature_id")
    return explore.histogram(t, "log_fc", -6, 6, 24, ["biotype"])


@query("a51_numeric_summary", """
    SELECT round(min(p_value), 9) AS min, round(quantile_cont(p_value, 0.25), 9) AS q1, round(median(p_value), 9) AS median,
           round(quantile_cont(p_value, 0.75), 9) AS q3, max(p_value) AS max, count(*) AS n, round(avg(p_value), 9) AS mean FROM c_fc""")
def numeric_summary(spark, d):
    s = explore.numeric_summary(stage(inputs.fold_changes(spark, d)), "p_value")
    return s.select(*[r(c, 9).alias(c) for c in ("min", "q1", "median", "q3")], "max", "n", r("mean", 9).alias("mean"))


@query("a56_list_coverage", """
    SELECT count(*) AS listed, count(o) AS mapped, count(*) - count(o) AS unmapped
    FROM (SELECT DISTINCT c_custkey, o_custkey AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey)""")
def list_coverage(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    m = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("target"))
    return explore.list_coverage(ids, m, "id", "target")


@query("a58_strand_check", """
    SELECT sum(l_orderkey) :: BIGINT AS unstranded, sum(l_partkey) :: BIGINT AS strand1, sum(l_suppkey) :: BIGINT AS strand2,
           CASE WHEN sum(l_partkey) >= sum(l_suppkey) THEN 'strand1' ELSE 'strand2' END AS largest FROM lineitem""")
def strand_check(spark, d):
    return explore.strand_check(table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("unstranded"), F.col("l_partkey").alias("strand1"), F.col("l_suppkey").alias("strand2")))


@query("a9_sample_correlation", """
    WITH g AS (SELECT feature_id, sample_id, cnt AS x FROM c_grid),
    s AS (SELECT sample_id, avg(x) AS mx, count(*) AS n FROM g GROUP BY 1)
    SELECT a.sample_id AS sample_1, b.sample_id AS sample_2, round(corr(a.x, b.x), 8) AS correlation
    FROM g a JOIN g b ON a.feature_id = b.feature_id AND a.sample_id < b.sample_id GROUP BY 1, 2""")
def sample_correlation(spark, d):
    m = stage(inputs.matrix(spark, d))
    n = m.agg(F.count_distinct("feature_id")).scalar()
    return explore.sample_correlation(m, "count", n).withColumn("correlation", r("correlation", 8))


@query("a10_a37_pca_importance")
def pca_importance(spark, d):
    from exprspark.catalog.counts import kept_matrix
    m = kept_matrix(spark, d)
    lib = stage(normalize.library_size(m))
    n = m.select("feature_id").distinct().count()
    _, importance = explore.pca_samples(normalize.log_cpm(m, lib), "log_cpm", 10, n, normalize.log_cpm_of_zero(lib), "sample")
    return importance


@query("a10_pca_scores_by_feature")
def pca_scores(spark, d):
    from exprspark.catalog.counts import kept_matrix
    m = kept_matrix(spark, d)
    lib = stage(normalize.library_size(m))
    n = m.select("feature_id").distinct().count()
    scores, _ = explore.pca_samples(normalize.log_cpm(m, lib), "log_cpm", 2, n, normalize.log_cpm_of_zero(lib), "feature")
    return scores


@query("a10_pca_cells")
def pca_cells(spark, d):
    scores, _ = explore.pca_vectors(inputs.vectors(spark, d), 10)
    return scores


@query("a37_explained_variance", """
    SELECT i AS pc, round(sqrt(v), 6) AS sdev, round(v / sum(v) OVER (), 6) AS proportion FROM (
      SELECT i, var_samp(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, (SELECT CAST(range AS INTEGER) AS i FROM range(1, 65)) GROUP BY 1)""")
def explained_variance(spark, d):
    x = inputs.vectors(spark, d).select(F.posexplode("vec").alias("p", "score")).select((F.col("p") + 1).alias("pc"), "score")
    return explore.explained_variance(x).select("pc", r("sdev").alias("sdev"), r("proportion").alias("proportion"))


@query("a55_covariate_r2", """
    WITH x AS (SELECT grp, lib_size AS y FROM c_lib JOIN c_samples USING (sample_id)),
    t AS (SELECT sum((y - m) * (y - m)) AS sst, sum((y - gm) * (y - gm)) AS ssw, count(*) AS n, count(DISTINCT grp) AS k FROM (
      SELECT grp, y, avg(y) OVER () AS m, avg(y) OVER (PARTITION BY grp) AS gm FROM x))
    SELECT 'group' AS covariate, round(1 - ssw / sst, 8) AS r2, round(1 - (ssw / sst) * (n - 1) / (n - k), 8) AS adj_r2 FROM t""")
def covariate_r2(spark, d):
    lib = normalize.library_size(inputs.matrix(spark, d)).select("sample_id", F.lit(1).alias("pc"), F.col("lib_size").alias("score"))
    c = explore.covariate_r2(lib, inputs.samples(spark, d), "group")
    return c.select("covariate", r("r2", 8).alias("r2"), r("adj_r2", 8).alias("adj_r2"))


@query("w1_rank_by_order", "SELECT feature_id, log_fc, row_number() OVER (ORDER BY log_fc, feature_id) AS rank FROM c_fc")
def rank_by_order(spark, d):
    return report.rank_rows(inputs.fold_changes(spark, d).select("feature_id", "log_fc"), [F.col("log_fc"), F.col("feature_id")])


@query("w8_mean_of_ranks", """
    WITH t AS (SELECT feature_id, p_value, log_cpm, rank() OVER (ORDER BY p_value) + (count(*) OVER (PARTITION BY p_value) - 1) / 2 AS rank_1,
      rank() OVER (ORDER BY log_cpm) + (count(*) OVER (PARTITION BY log_cpm) - 1) / 2 AS rank_2 FROM c_fc)
    SELECT feature_id, p_value, log_cpm, rank_1, rank_2, (rank_1 + rank_2) / 2 AS mean_rank FROM t""")
def mean_of_two_ranks(spark, d):
    t = stage(inputs.fold_changes(spark, d).select("feature_id", "p_value", "log_cpm"))
    return mean_of_ranks(t, "p_value", "log_cpm", "feature_id")


@query("o1_o2_o3_top_rows", "SELECT feature_id, lr, log_fc FROM c_fc ORDER BY lr DESC, abs(log_fc) DESC, feature_id LIMIT 15")
def top_rows(spark, d):
    t = inputs.fold_changes(spark, d).select("feature_id", "lr", "log_fc")
    return report.head(t, 15, F.col("lr").desc(), F.abs("log_fc").desc(), F.col("feature_id"))


@query("o4_both_ends", """
    (SELECT feature_id, log_fc FROM c_fc ORDER BY log_fc DESC, feature_id LIMIT 50) UNION ALL
    (SELECT feature_id, log_fc FROM c_fc ORDER BY log_fc, feature_id DESC LIMIT 50)""")
def both_ends(spark, d):
    t = stage(inputs.fold_changes(spark, d).select("feature_id", "log_fc"))
    return report.both_ends(t, 100, [F.col("log_fc").desc(), F.col("feature_id")], [F.col("log_fc"), F.col("feature_id").desc()])


@query("o5_capped_list", """
    WITH t AS (SELECT *, row_number() OVER (ORDER BY p_value, feature_id) AS rn, count(*) FILTER (p_value < 0.05) OVER () > 50 AS many FROM c_deg)
    SELECT feature_id, p_value FROM t WHERE CASE WHEN many THEN rn <= 50 ELSE fdr < 0.05 END""")
def capped_list(spark, d):
    return report.capped_list(staged_deg(spark, d), 50, 0.05, [F.col("p_value"), F.col("feature_id")]).select("feature_id", "p_value")


@query("o5_capped_list_fdr", """
    SELECT feature_id, p_value FROM c_deg WHERE (SELECT count(*) FROM c_deg WHERE fdr < 0.5) <= 100000 AND fdr < 0.5""")
def capped_list_fdr(spark, d):
    return report.capped_list(staged_deg(spark, d), 100_000, 0.5, [F.col("p_value"), F.col("feature_id")], fdr_only=True).select("feature_id", "p_value")


@query("o6_bounded_top", """
    WITH t AS (SELECT feature_id, p_value, row_number() OVER (ORDER BY p_value, feature_id) AS place FROM c_deg)
    SELECT feature_id, CAST(place AS INTEGER) AS place FROM t WHERE place <= (SELECT least(greatest(count(*) FILTER (fdr < 0.05), 20), 100) FROM c_deg)""")
def bounded_top(spark, d):
    t = report.bounded_top(staged_deg(spark, d), F.col("fdr") < 0.05, 20, 100, [F.col("p_value"), F.col("feature_id")])
    return t.select("feature_id", "place")


@query("o7_top_per_direction", """
    SELECT feature_id, CASE WHEN log_fc > 0 THEN 'UP' ELSE 'DN' END AS direction, log_fc FROM c_fc WHERE log_fc <> 0
    QUALIFY row_number() OVER (PARTITION BY log_fc > 0 ORDER BY p_value, feature_id) <= 10""")
def top_per_direction(spark, d):
    t = inputs.fold_changes(spark, d).withColumn("direction", sc.direction("log_fc")).filter("direction is not null")
    return report.top_per_group(t, ["direction"], 10, [F.col("p_value"), F.col("feature_id")]).select("feature_id", "direction", "log_fc")


@query("o8_first_distinct_symbols", "SELECT symbol, min(p_value) AS p_value FROM c_deg WHERE symbol IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 9")
def first_distinct(spark, d):
    t = inputs.fold_changes(spark, d).join(inputs.annotations(spark, d), "feature_id")
    return report.first_distinct(t, "symbol", 9, "p_value")


cte("c_top50", "SELECT feature_id FROM c_fc ORDER BY p_value, feature_id LIMIT 50")


@query("o9_heatmap_matrix", """
    WITH g AS (SELECT feature_id, sample_id, coalesce(cnt, 0) AS cnt FROM c_top50 CROSS JOIN (SELECT sample_id FROM c_samples) LEFT JOIN c_matrix USING (feature_id, sample_id)),
    s AS (SELECT feature_id, avg(cnt) AS mu, stddev_samp(cnt) AS sd FROM g GROUP BY 1)
    SELECT feature_id, sample_id, round((cnt - mu) / sd, 6) AS z FROM g JOIN s USING (feature_id) WHERE sd > 0""")
def heatmap_matrix(spark, d):
    """Dense standardized rows of the 50 best features."""
    top = stage(inputs.fold_changes(spark, d).orderBy("p_value", "feature_id").limit(50).select("feature_id"))
    s = inputs.samples(spark, d)
    m = clean.restrict_to(inputs.matrix(spark, d), top, "feature_id")
    dense = normalize.densify(m, "count", s)
    n = s.agg(F.count(F.lit(1))).scalar()
    return normalize.row_zscore(dense, "count", n).select("feature_id", "sample_id", r("z").alias("z"))


@query("r1_r5_pivot_unpivot", """
    WITH g AS (SELECT feature_id, grp AS sample_id, sum(cnt) AS value FROM c_matrix JOIN c_samples USING (sample_id) GROUP BY 1, 2)
    SELECT f.feature_id, r_name AS sample_id, coalesce(value, 0) AS value FROM (SELECT DISTINCT feature_id FROM g) f CROSS JOIN region LEFT JOIN g ON g.feature_id = f.feature_id AND g.sample_id = r_name""")
def pivot_unpivot(spark, d):
    """Counts summed by group, one column per group, and back."""
    names = sorted(row["r_name"] for row in table(spark, d, "region").collect())
    grouped = inputs.matrix(spark, d).join(inputs.samples(spark, d), "sample_id").groupBy("feature_id", F.col("group").alias("sample_id")).agg(F.sum("count").alias("count"))
    return clean.to_long(clean.to_wide(grouped, "count", names), ["feature_id"])


@query("r4_interleaved_lists", """
    WITH l AS (SELECT 1 AS place, 'up_strong' AS name, feature_id, log_fc FROM c_fc WHERE log_fc > 0 AND p_value <= 0.5 UNION ALL SELECT 2, 'dn_strong', feature_id, log_fc FROM c_fc WHERE log_fc < 0 AND p_value <= 0.5
          UNION ALL SELECT 3, 'up_all', feature_id, log_fc FROM c_fc WHERE log_fc > 0 UNION ALL SELECT 4, 'dn_all', feature_id, log_fc FROM c_fc WHERE log_fc < 0)
    SELECT CAST(place AS INTEGER) AS place, name, feature_id, log_fc FROM l""")
def interleaved_lists(spark, d):
    """Lists of risen and fallen features, alternating from the strictest limit on."""
    t = stage(inputs.fold_changes(spark, d))
    limits = {"strong": F.col("p_value") <= 0.5, "all": F.lit(True)}
    up = {f"up_{k}": t.filter((F.col("log_fc") > 0) & c) for k, c in limits.items()}
    dn = {f"dn_{k}": t.filter((F.col("log_fc") < 0) & c) for k, c in limits.items()}
    parts = [part.select(F.lit(i).alias("place"), F.lit(name).alias("name"), "feature_id", "log_fc") for i, (name, part) in enumerate(report.interleave(up, dn).items(), 1)]
    return reduce(DataFrame.unionByName, parts)


@query("a60_ranked_list", """
    WITH t AS (SELECT * FROM c_fc ORDER BY abs(log_fc) DESC, feature_id LIMIT 500),
    l AS (SELECT 'ALL' AS list, feature_id, log_fc AS score FROM t UNION ALL SELECT 'UP', feature_id, log_fc FROM t WHERE log_fc > 0
          UNION ALL SELECT 'DN', feature_id, log_fc FROM t WHERE log_fc < 0)
    SELECT list, feature_id, score, row_number() OVER (PARTITION BY list ORDER BY score DESC, feature_id) AS rank FROM l""")
def ranked_list(spark, d):
    return report.ranked_list(inputs.fold_changes(spark, d), by="log_fc", max_n=500).select("list", "feature_id", "score", "rank")


@query("a60_ranked_list_by_p", """
    WITH m AS (SELECT feature_id, CAST(p_size AS VARCHAR) || '-' || p_brand AS target FROM c_fc JOIN part ON CAST(p_partkey AS VARCHAR) = feature_id WHERE p_size > 10),
    t AS (SELECT target, log_fc, CASE WHEN p_value = 0 THEN -log10(2.2250738585072014e-308) ELSE -log10(p_value) END AS score FROM c_fc JOIN m USING (feature_id)),
    l AS (SELECT 'ALL' AS list, target, score FROM t UNION ALL SELECT 'UP', target, score FROM t WHERE log_fc > 0 UNION ALL SELECT 'DN', target, score FROM t WHERE log_fc < 0)
    SELECT list, target AS feature_id, round(max(score) + 0.0, 6) AS score FROM l GROUP BY 1, 2""")
def ranked_list_by_p(spark, d):
    m = table(spark, d, "part").filter("p_size > 10").select(
        F.col("p_partkey").cast("string").alias("feature_id"), F.concat_ws("-", "p_size", "p_brand").alias("target"))
    return report.ranked_list(inputs.fold_changes(spark, d), m, by="p_value").select("list", "feature_id", r(F.col("score") + 0.0).alias("score"))
