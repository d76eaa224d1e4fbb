"""Alignment, interval, coverage and read queries."""

from pyspark.sql import functions as F

from exprspark.catalog import counts  # noqa: F401
from exprspark.catalog.registry import cte, query, r
from exprspark.operators import intervals as iv
from exprspark.operators import reads as rd
from exprspark.plans import inputs
from exprspark.plans.inputs import table
from exprspark.session import stage

cte("c_iv", """
    SELECT 'chr' || l_suppkey AS chrom, l_orderkey AS "start", l_orderkey + CAST(l_quantity AS BIGINT) AS "end",
           CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END AS strand, l_returnflag AS sample_id,
           l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS read_id FROM lineitem""")
cte("c_aln", """
    SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS read_id,
           CASE WHEN l_suppkey % 10 = 0 THEN 'chrM' ELSE 'chr' || (l_suppkey % 10) END AS chrom, l_orderkey AS "start",
           l_orderkey + CAST(l_quantity AS BIGINT) AS "end", CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END AS strand, l_linenumber * 10 AS mapq,
           CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 1027 ELSE 259 END + CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END + CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END AS flag,
           CAST(l_quantity * CASE WHEN l_linestatus = 'F' THEN -10 ELSE 10 END AS INTEGER) AS tlen, l_returnflag AS sample_id FROM lineitem""")


def sizes(spark, d):
    """Chromosome sizes: the end of the last interval; and one sequence without any."""
    empty = spark.range(1).select(F.lit("chrEmpty").alias("chrom"), F.lit(500).cast("long").alias("size"))
    return inputs.intervals(spark, d).groupBy("chrom").agg((F.max("end") + 10).alias("size")).unionByName(empty)


cte("c_sizes", """SELECT chrom, max("end") + 10 AS size FROM c_iv GROUP BY 1 UNION ALL SELECT 'chrEmpty', 500""")


@query("p25_filter_alignments", """
    SELECT read_id, chrom, flag, mapq FROM c_aln WHERE mapq >= 20 AND flag & 3 = 3 AND flag & 3332 = 0 AND regexp_matches(chrom, 'chr[1-9,X,Y]')""")
def filter_alignments(spark, d):
    return iv.filter_alignments(inputs.alignments(spark, d), require=3).select("read_id", "chrom", "flag", "mapq")


@query("p25_filter_keep_duplicates", """
    SELECT read_id, flag FROM c_aln WHERE mapq >= 20 AND flag & 2308 = 0 AND chrom <> 'chrM'""")
def filter_keep_duplicates(spark, d):
    return iv.filter_alignments(inputs.alignments(spark, d), remove=iv.REMOVE_FLAGS_KEEP_DUPLICATES).select("read_id", "flag")


@query("p31_cutsites", """
    SELECT read_id, chrom, CASE WHEN strand = '+' THEN "start" + 4 ELSE "end" - 5 END AS "start", CASE WHEN strand = '+' THEN "start" + 5 ELSE "end" - 4 END AS "end" FROM c_iv""")
def cutsites(spark, d):
    return iv.cutsites(inputs.intervals(spark, d)).select("read_id", "chrom", "start", "end")


@query("p32_slop", """
    SELECT read_id, chrom, greatest("start" - 100, 0) AS "start", least("end" + 100, size) AS "end" FROM c_iv JOIN c_sizes USING (chrom)""")
def slop(spark, d):
    return iv.slop(inputs.intervals(spark, d), sizes(spark, d), 100).select("read_id", "chrom", "start", "end")


@query("p33_fragments", """
    SELECT read_id, 'fixed' AS kind, CASE WHEN strand = '+' THEN "start" ELSE greatest("end" - 60, 0) END AS "start", CASE WHEN strand = '+' THEN "start" + 60 ELSE "end" END AS "end" FROM c_aln
    UNION ALL SELECT read_id, 'pair', "start", "start" + tlen FROM c_aln WHERE tlen > 0""")
def fragments(spark, d):
    a = inputs.alignments(spark, d)
    fixed = iv.fragments(a, 60).select("read_id", F.lit("fixed").alias("kind"), "start", "end")
    return fixed.unionByName(iv.fragments(a).select("read_id", F.lit("pair").alias("kind"), "start", "end"))


cte("c_depth", """
    WITH e AS (SELECT sample_id, chrom, "start" AS pos, 1 AS d FROM c_iv UNION ALL SELECT sample_id, chrom, "end", -1 FROM c_iv),
    g AS (SELECT sample_id, chrom, pos, sum(d) AS d FROM e GROUP BY 1, 2, 3 HAVING sum(d) <> 0),
    r AS (SELECT sample_id, chrom, pos AS "start", lead(pos) OVER w AS "end", sum(d) OVER (PARTITION BY sample_id, chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS v FROM g WINDOW w AS (PARTITION BY sample_id, chrom ORDER BY pos))
    SELECT sample_id, chrom, "start", "end", CAST(v AS DOUBLE) AS value FROM r WHERE "end" IS NOT NULL""")


@query("a43_w5_coverage", """SELECT * FROM c_depth WHERE value <> 0""")
def coverage(spark, d):
    return iv.coverage(inputs.intervals(spark, d), ["sample_id", "chrom"])


@query("a43_coverage_scaled", """
    SELECT sample_id, chrom, "start", "end", round(value * m, 9) AS value FROM c_depth JOIN (SELECT sample_id, 1e4 / count(*) AS m FROM c_iv GROUP BY 1) USING (sample_id) WHERE value <> 0""")
def coverage_scaled(spark, d):
    x = inputs.intervals(spark, d)
    scale = x.groupBy("sample_id").agg((F.lit(1e4) / F.count(F.lit(1))).alias("multiplier"))
    return iv.coverage(x, ["sample_id", "chrom"], scale=scale, tile=1 << 12).withColumn("value", r("value", 9))


@query("a43_coverage_with_zeros", """
    WITH b AS (SELECT sample_id, chrom, "start", "end", value FROM c_depth
      UNION ALL SELECT sample_id, chrom, 0, min("start"), 0 FROM c_iv GROUP BY 1, 2 HAVING min("start") > 0
      UNION ALL SELECT sample_id, chrom, max("end"), any_value(size), 0 FROM c_iv JOIN c_sizes USING (chrom) GROUP BY 1, 2)
    SELECT sample_id, chrom, "start", "end", value FROM b
    UNION ALL SELECT u, z.chrom, 0, size, 0 FROM c_sizes z, (SELECT DISTINCT sample_id AS u FROM c_iv)
      WHERE NOT EXISTS (SELECT 1 FROM c_iv i WHERE i.chrom = z.chrom AND i.sample_id = u)""")
def coverage_with_zeros(spark, d):
    return iv.coverage(inputs.intervals(spark, d), ["sample_id", "chrom"], sizes=sizes(spark, d), tile=1 << 13)


cte("c_islands", """
    WITH o AS (SELECT sample_id, chrom, "start", "end", max("end") OVER (PARTITION BY sample_id, chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM c_iv),
    g AS (SELECT *, sum(CASE WHEN m IS NULL OR "start" > m THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id, chrom ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS k FROM o)
    SELECT sample_id, chrom, min("start") AS "start", max("end") AS "end" FROM g GROUP BY sample_id, chrom, k""")


@query("w6_merge_intervals", """SELECT * FROM c_islands WHERE "end" - "start" >= 20""")
def merge(spark, d):
    return iv.merge_intervals(inputs.intervals(spark, d), ["sample_id", "chrom"], min_length=20, tile=1 << 12)


def tracks(spark, d):
    return iv.coverage(inputs.intervals(spark, d), ["sample_id", "chrom"]).withColumnRenamed("sample_id", "track")


cte("c_union", """
    WITH p AS (SELECT chrom, "start" AS pos FROM c_depth WHERE value <> 0 UNION SELECT chrom, "end" FROM c_depth WHERE value <> 0),
    s AS (SELECT chrom, pos AS "start", lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS "end" FROM p)
    SELECT s.chrom, s."start", s."end", sample_id AS track, value FROM s JOIN c_depth c ON c.chrom = s.chrom AND c."start" <= s."start" AND c."end" >= s."end" WHERE value <> 0""")


@query("j16_union_tracks", "SELECT * FROM c_union")
def union_tracks(spark, d):
    return iv.union_tracks(stage(tracks(spark, d)), tile=1 << 12)


@query("a44_average_tracks", """
    WITH a AS (SELECT chrom, "start", "end", sum(value) / 3 AS v FROM c_union GROUP BY 1, 2, 3),
    m AS (SELECT *, lag(v) OVER w IS DISTINCT FROM v OR lag("end") OVER w IS DISTINCT FROM "start" AS new FROM a WINDOW w AS (PARTITION BY chrom ORDER BY "start")),
    g AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start" ROWS UNBOUNDED PRECEDING) AS k FROM m)
    SELECT chrom, min("start") AS "start", max("end") AS "end", round(any_value(v), 9) AS value FROM g GROUP BY chrom, k""")
def average_tracks(spark, d):
    return iv.average_tracks(tracks(spark, d), tile=1 << 12).withColumn("value", r("value", 9))


cte("c_features", """
    SELECT 'I' || o_custkey || '_' || o_orderkey AS interval_id, 'chr' || (o_orderkey % (SELECT max(l_suppkey) + 1 FROM lineitem)) AS chrom, o_orderkey AS "start", o_orderkey + 40 + o_custkey % 60 AS "end" FROM orders""")


def features(spark, d):
    n = table(spark, d, "lineitem").agg(F.max("l_suppkey") + 1).scalar()
    o = table(spark, d, "orders")
    return o.select(
        F.concat(F.lit("I"), "o_custkey", F.lit("_"), "o_orderkey").alias("interval_id"),
        F.concat(F.lit("chr"), (F.col("o_orderkey") % n).cast("string")).alias("chrom"),
        F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 40 + F.col("o_custkey") % 60).alias("end"))


cte("c_assigned", """
    WITH i AS (SELECT sample_id, read_id, chrom, "start", "end", row_number() OVER () AS rid FROM c_iv),
    h AS (SELECT rid, any_value(sample_id) AS sample_id, count(interval_id) AS n, min(interval_id) AS interval_id FROM i LEFT JOIN c_features f ON f.chrom = i.chrom AND f."start" < i."end" AND f."end" > i."start" GROUP BY 1)
    SELECT sample_id, CASE WHEN n = 0 THEN 'no_feature' WHEN n = 1 THEN 'assigned' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN interval_id END AS interval_id, count(*) AS n FROM h GROUP BY 1, 2, 3""")


@query("j15_count_overlaps", "SELECT * FROM c_assigned")
def count_overlaps(spark, d):
    return iv.count_overlaps(inputs.intervals(spark, d), features(spark, d))


@query("j15_count_by_five_prime", """
    WITH i AS (SELECT sample_id, chrom, CASE WHEN strand = '-' THEN "end" - 1 ELSE "start" END AS p, row_number() OVER () AS rid FROM c_iv),
    h AS (SELECT rid, any_value(sample_id) AS sample_id, count(interval_id) AS n, min(interval_id) AS interval_id FROM i LEFT JOIN c_features f ON f.chrom = i.chrom AND f."start" <= p AND f."end" > p GROUP BY 1)
    SELECT sample_id, CASE WHEN n = 0 THEN 'no_feature' WHEN n = 1 THEN 'assigned' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN interval_id END AS interval_id, count(*) AS n FROM h GROUP BY 1, 2, 3""")
def count_by_five_prime(spark, d):
    return iv.count_overlaps(inputs.intervals(spark, d), features(spark, d), by_start=True, tile=1 << 12)


cte("c_fragments", """
    SELECT sample_id, read_id, chrom, "start", "end" FROM c_iv UNION ALL
    SELECT sample_id, read_id, chrom, "start" + 100 + length(read_id) % 7 * 40, "end" + 100 + length(read_id) % 7 * 40 FROM c_iv WHERE strand = '+'""")


def mates(spark, d):
    """Forward reads get a mate some way downstream, often on another feature; reverse reads have none."""
    first = inputs.intervals(spark, d).select("sample_id", "read_id", "chrom", "start", "end", "strand")
    far = 100 + F.length("read_id") % 7 * 40
    second = first.filter("strand = '+'").withColumn("start", F.col("start") + far).withColumn("end", F.col("end") + far)
    return first.unionByName(second).drop("strand")


@query("j15_count_by_pair", """
    WITH h AS (SELECT i.sample_id, i.read_id, count(DISTINCT interval_id) AS n, min(interval_id) AS interval_id
        FROM c_fragments i LEFT JOIN c_features f ON f.chrom = i.chrom AND f."start" < i."end" AND f."end" > i."start" GROUP BY 1, 2)
    SELECT sample_id, CASE WHEN n = 0 THEN 'no_feature' WHEN n = 1 THEN 'assigned' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN interval_id END AS interval_id, count(*) AS n FROM h GROUP BY 1, 2, 3""")
def count_by_pair(spark, d):
    """Fragments by what either mate meets."""
    return iv.count_overlaps(mates(spark, d), features(spark, d), by_pair=True)


@query("a40_frip", """
    SELECT sample_id, CAST(a AS BIGINT) AS assigned, CAST(a + u AS BIGINT) AS total, round(a / (a + u), 9) AS frip FROM (
      SELECT sample_id, coalesce(sum(n) FILTER (status = 'assigned'), 0) AS a, coalesce(sum(n) FILTER (status = 'no_feature'), 0) AS u FROM c_assigned GROUP BY 1)""")
def frip(spark, d):
    return iv.frip(iv.count_overlaps(inputs.intervals(spark, d), features(spark, d))).withColumn("frip", r("frip", 9))


@query("a39_mito_percent", """
    SELECT sample_id, count(*) FILTER (chrom = 'chrM') AS mito, count(*) AS mapped, round(100.0 * count(*) FILTER (chrom = 'chrM') / count(*), 9) AS percent FROM c_aln WHERE flag & 4 = 0 GROUP BY 1""")
def mito_percent(spark, d):
    return iv.mito_read_percent(inputs.alignments(spark, d)).withColumn("percent", r("percent", 9))


@query("a59_alignment_summary", """
    SELECT sample_id, count(*) AS total, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 1 <> 0) AS paired, count(*) FILTER (flag & 2 <> 0) AS proper_pair,
           count(*) FILTER (flag & 256 <> 0) AS secondary, count(*) FILTER (flag & 2048 <> 0) AS supplementary, count(*) FILTER (flag & 1024 <> 0) AS duplicates, count(*) FILTER (flag & 512 <> 0) AS qc_fail
    FROM c_aln GROUP BY 1""")
def alignment_summary(spark, d):
    return iv.alignment_summary(inputs.alignments(spark, d))


@query("a59_reads_per_chromosome", "SELECT sample_id, chrom, count(*) AS n FROM c_aln WHERE flag & 4 = 0 GROUP BY 1, 2")
def reads_per_chromosome(spark, d):
    return iv.reads_per_chromosome(inputs.alignments(spark, d))


@query("a41_insert_size_metrics", """
    SELECT sample_id, count(*) AS pairs, round(avg(tlen), 9) AS mean, median(tlen) AS median FROM c_aln WHERE tlen > 0 AND flag & 1 = 1 AND flag & 4 = 0 GROUP BY 1""")
def insert_size_metrics(spark, d):
    m = iv.insert_size_metrics(iv.insert_sizes(inputs.alignments(spark, d)))
    return m.select("sample_id", "pairs", r("mean", 9).alias("mean"), "median")


@query("a41_insert_size_histogram", """
    SELECT sample_id, tlen AS insert_size, count(*) AS n FROM c_aln WHERE tlen > 0 AND flag & 1 = 1 AND flag & 4 = 0 GROUP BY 1, 2""")
def insert_size_histogram(spark, d):
    return iv.insert_sizes(inputs.alignments(spark, d))


@query("a45_mark_duplicates", """
    WITH a AS (SELECT *, CASE WHEN strand = '-' THEN "end" ELSE "start" END AS five FROM c_aln),
    k AS (SELECT sample_id, chrom, five, strand, min(read_id) AS keep FROM a GROUP BY 1, 2, 3, 4)
    SELECT sample_id, chrom, count(*) AS n, count(*) FILTER (read_id <> keep) AS duplicates FROM a JOIN k USING (sample_id, chrom, five, strand) GROUP BY 1, 2""")
def mark_duplicates(spark, d):
    m = iv.mark_duplicates(inputs.alignments(spark, d))
    return m.groupBy("sample_id", "chrom").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_duplicate").alias("duplicates"))


cte("c_mates", """
    SELECT l_orderkey % 97 || '_' || l_orderkey || '_' || (l_linenumber - 1) // 2 AS read_id, 'chr' || l_suppkey % 3 AS chrom,
           l_orderkey % 4 * 10 AS "start", l_orderkey % 4 * 10 + 20 + l_partkey % 3 AS "end", CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand,
           CASE WHEN l_quantity > 45 THEN 256 ELSE 0 END + l_linenumber % 2 AS flag, l_returnflag AS sample_id FROM lineitem""")


def pairs(spark, d):
    """Two records of an order as the mates of a pair, with few positions; some are unmated, some secondary."""
    n = F.col("l_linenumber")
    first = F.col("l_orderkey") % 4 * 10
    return table(spark, d, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey") % 97, "l_orderkey", F.expr("(l_linenumber - 1) div 2")).alias("read_id"), F.concat(F.lit("chr"), F.col("l_suppkey") % 3).alias("chrom"),
        first.alias("start"), (first + 20 + F.col("l_partkey") % 3).alias("end"), F.when(n % 2 == 0, "-").otherwise("+").alias("strand"),
        (F.when(F.col("l_quantity") > 45, 256).otherwise(0) + n % 2).cast("int").alias("flag"), F.col("l_returnflag").alias("sample_id"))


@query("a45_mark_duplicate_pairs", """
    WITH a AS (SELECT *, chrom || ':' || CASE WHEN strand = '-' THEN "end" ELSE "start" END || ':' || strand AS e FROM c_mates),
    p AS (SELECT sample_id, read_id, min(e) AS e1, max(e) AS e2 FROM a WHERE flag & 256 = 0 GROUP BY 1, 2 HAVING count(*) = 2),
    k AS (SELECT *, read_id <> min(read_id) OVER (PARTITION BY sample_id, e1, e2) AS dup FROM p)
    SELECT a.sample_id, a.read_id, a.chrom, a."start", a."end", a.strand, CAST(a.flag AS INTEGER) AS flag, coalesce(dup AND flag & 256 = 0, false) AS is_duplicate FROM a LEFT JOIN k USING (sample_id, read_id)""")
def mark_duplicate_pairs(spark, d):
    return iv.mark_duplicate_pairs(pairs(spark, d))


cte("c_clipped", """
    SELECT *, CASE length(read_id) % 4 WHEN 0 THEN '3S' WHEN 1 THEN '1H2S' ELSE '' END AS lead, CASE length(read_id) % 3 WHEN 0 THEN '2S' WHEN 1 THEN '4S1H' ELSE '' END AS tail FROM c_mates""")
cte("c_clipped_five", """
    SELECT *, CASE WHEN strand = '-' THEN "end" + CASE length(read_id) % 3 WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 0 END ELSE "start" - CASE WHEN length(read_id) % 4 < 2 THEN 3 ELSE 0 END END AS five FROM c_clipped""")


def clipped_pairs(spark, d):
    """The mates with clips at either side, which hide where equal fragments begin."""
    n = F.length("read_id")
    lead = F.when(n % 4 == 0, "3S").when(n % 4 == 1, "1H2S").otherwise("")
    tail = F.when(n % 3 == 0, "2S").when(n % 3 == 1, "4S1H").otherwise("")
    return pairs(spark, d).withColumn("cigar", F.concat(lead, (F.col("end") - F.col("start")).cast("string"), F.lit("M"), tail))


@query("a45_mark_clipped_pairs", """
    WITH a AS (SELECT *, chrom || ':' || five || ':' || strand AS e FROM c_clipped_five),
    p AS (SELECT sample_id, read_id, min(e) AS e1, max(e) AS e2 FROM a WHERE flag & 256 = 0 GROUP BY 1, 2 HAVING count(*) = 2),
    k AS (SELECT *, read_id <> min(read_id) OVER (PARTITION BY sample_id, e1, e2) AS dup FROM p)
    SELECT a.sample_id, a.read_id, a.chrom, a."start", a."end", a.strand, coalesce(dup AND flag & 256 = 0, false) AS is_duplicate FROM a LEFT JOIN k USING (sample_id, read_id)""")
def mark_clipped_pairs(spark, d):
    return iv.mark_duplicate_pairs(clipped_pairs(spark, d)).drop("cigar", "flag")


@query("a45_mark_clipped_reads", """
    WITH a AS (SELECT *, CASE WHEN strand = '-' THEN "end" + CASE WHEN mapq % 30 = 0 THEN 5 ELSE 0 END ELSE "start" - CASE WHEN mapq % 20 = 0 THEN 3 ELSE 0 END END AS five FROM c_aln)
    SELECT sample_id, read_id, chrom, "start", "end", strand, read_id <> min(read_id) OVER (PARTITION BY sample_id, chrom, five, strand) AS is_duplicate FROM a""")
def mark_clipped_reads(spark, d):
    """Single reads with clips at either side."""
    a = inputs.alignments(spark, d)
    cigar = F.concat(F.when(F.col("mapq") % 20 == 0, "1H2S").otherwise(""), (F.col("end") - F.col("start")).cast("string"), F.lit("M"), F.when(F.col("mapq") % 30 == 0, "5S").otherwise(""))
    return iv.mark_duplicates(a.withColumn("cigar", cigar)).select("sample_id", "read_id", "chrom", "start", "end", "strand", "is_duplicate")


@query("a46_enriched_windows", """
    WITH w AS (SELECT sample_id, chrom, CAST(floor(("start" + "end") / 2 / 2000) AS BIGINT) AS win, count(*) AS n FROM c_aln GROUP BY 1, 2, 3),
    t AS (SELECT sample_id, sum(n) AS tot FROM w GROUP BY 1), g AS (SELECT sum(ceil(size / 2000)) AS nw FROM (SELECT chrom, max("end") AS size FROM c_aln GROUP BY 1)),
    l AS (SELECT w.*, greatest(tot / nw, sum(n) OVER (PARTITION BY sample_id, chrom ORDER BY win RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5) AS lam FROM w JOIN t USING (sample_id), g),
    p AS (SELECT *, greatest(0, 1 - (SELECT sum(exp(i * ln(lam) - lam - lgamma(i + 1))) FROM range(0, n) q(i))) AS p FROM l),
    b AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY p) AS k, count(*) OVER (PARTITION BY sample_id) AS nn FROM p),
    q AS (SELECT *, min(least(1, p * nn / k)) OVER (PARTITION BY sample_id ORDER BY k DESC) AS qv FROM b),
    s AS (SELECT sample_id, chrom, win, win - row_number() OVER (PARTITION BY sample_id, chrom ORDER BY win) AS grp FROM q WHERE qv < 0.9)
    SELECT sample_id, chrom, min(win) * 2000 AS "start", (max(win) + 1) * 2000 AS "end" FROM s GROUP BY sample_id, chrom, grp""")
def enriched_windows(spark, d):
    a = inputs.alignments(spark, d)
    s = a.groupBy("chrom").agg(F.max("end").alias("size"))
    return iv.call_enriched(a, s, width=2000, local=(2,), q=0.9)


@query("o10_position_sorted", 'SELECT chrom, "start", "end", strand FROM c_iv')
def position_sorted(spark, d):
    return iv.position_sorted(inputs.intervals(spark, d).select("chrom", "start", "end", "strand"))


cte("c_reads", """
    SELECT doc_id || '_' || k AS read_id, source AS sample_id, CAST(doc_id % 2 + 1 AS INTEGER) AS mate,
           translate(upper(substring(t, k * 80 + 1, 80)), 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTA') AS seq FROM (
      SELECT *, unnest(range(0, (length(t) + 79) // 80)) AS k FROM (SELECT doc_id, source, regexp_replace(text, '[^a-zA-Z]', 'n', 'g') AS t FROM documents))""")


def reads(spark, d):
    """Whole texts as reads of 80 letters: letters become bases, everything else N; quality from the letter."""
    letters = F.regexp_replace("text", "[^a-zA-Z]", "n")
    w = table(spark, d, "documents").select(
        "doc_id", "source", F.posexplode(F.regexp_extract_all(letters, F.lit(".{1,80}"), F.lit(0))).alias("k", "piece"))
    seq = F.translate(F.upper("piece"), "BDEFHIJKLMOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTA")
    return w.select(
        F.concat_ws("_", "doc_id", "k").alias("read_id"), F.col("source").alias("sample_id"), (F.col("doc_id") % 2 + 1).cast("int").alias("mate"),
        seq.alias("seq"), F.translate(seq, "ACGTN", "IH5#!").alias("qual"))


@query("p35_trim_reads", """
    WITH t AS (SELECT *, CASE WHEN instr(seq, 'ACGTA') > 0 THEN instr(seq, 'ACGTA') - 1 WHEN seq LIKE '%ACGT' THEN length(seq) - 4 WHEN seq LIKE '%ACG' THEN length(seq) - 3
        WHEN seq LIKE '%AC' THEN length(seq) - 2 WHEN seq LIKE '%A' THEN length(seq) - 1 ELSE length(seq) END AS cut FROM c_reads),
    u AS (SELECT read_id, sample_id, left(seq, cut) AS seq, cut FROM t)
    SELECT read_id, sample_id, seq FROM u WHERE cut >= 31 AND cut - length(replace(seq, 'N', '')) <= 0.2 * cut""")
def trim_reads(spark, d):
    return rd.trim_reads(reads(spark, d), adapter="ACGTA", min_overlap=1, max_n=0.2).select("read_id", "sample_id", "seq")


@query("p35_trim_tolerant", """
    WITH p AS (SELECT read_id, sample_id, seq, unnest(range(0, length(seq) - 2)) AS i FROM c_reads),
    o AS (SELECT *, least(length(seq) - i, 10) AS k FROM p),
    m AS (SELECT read_id, sample_id, seq, i, k, len(list_filter(range(1, k + 1), lambda j: seq[i + j] <> 'ACGTACGTAC'[j])) AS wrong FROM o),
    c AS (SELECT read_id, min(i) AS cut FROM m WHERE wrong <= floor(k * 0.2) GROUP BY 1),
    u AS (SELECT r.read_id, sample_id, left(seq, CAST(coalesce(cut, length(seq)) AS INTEGER)) AS seq FROM c_reads r LEFT JOIN c USING (read_id))
    SELECT * FROM u WHERE length(seq) >= 31 AND length(seq) - length(replace(seq, 'N', '')) <= 0.2 * length(seq)""")
def trim_tolerant(spark, d):
    """One substitution for five bases of overlap."""
    return rd.trim_reads(reads(spark, d), adapter="ACGTACGTAC", max_n=0.2, errors=0.2).select("read_id", "sample_id", "seq")


@query("p35_trim_pairs", """
    WITH t AS (SELECT *, CASE WHEN instr(seq, 'ACGTA') > 0 THEN instr(seq, 'ACGTA') - 1 WHEN seq LIKE '%ACGT' THEN length(seq) - 4 WHEN seq LIKE '%ACG' THEN length(seq) - 3 ELSE length(seq) END AS cut,
        CAST(split_part(read_id, '_', 1) AS BIGINT) // 2 || '_' || split_part(read_id, '_', 2) AS pair FROM c_reads),
    u AS (SELECT pair, mate, left(seq, cut) AS seq, cut >= 31 AND cut - length(replace(left(seq, cut), 'N', '')) <= 0.2 * cut AS ok FROM t)
    SELECT pair AS read_id, mate, seq FROM u WHERE pair IN (SELECT pair FROM u GROUP BY 1 HAVING bool_and(ok))""")
def trim_pairs(spark, d):
    pair = F.concat_ws("_", F.expr("cast(split_part(read_id, '_', 1) as bigint) div 2"), F.split_part("read_id", F.lit("_"), F.lit(2)))
    t = reads(spark, d).withColumn("read_id", pair).select("read_id", "mate", "seq")
    return rd.trim_reads(t, adapter="ACGTA", min_overlap=3, max_n=0.2, paired=True)


@query("a47_position_quality", """
    WITH b AS (SELECT sample_id, i AS pos, seq[i] AS base FROM (SELECT sample_id, seq, unnest(range(1, length(seq) + 1)) AS i FROM c_reads))
    SELECT sample_id, CAST(pos AS INTEGER) AS pos, count(*) AS bases, round(sum(CASE base WHEN 'A' THEN 40 WHEN 'C' THEN 39 WHEN 'G' THEN 20 WHEN 'T' THEN 2 ELSE 0 END) / count(*), 9) AS mean_quality,
           round(count(*) FILTER (base = 'A') / count(*), 9) AS share_a, round(count(*) FILTER (base = 'C') / count(*), 9) AS share_c, round(count(*) FILTER (base = 'G') / count(*), 9) AS share_g,
           round(count(*) FILTER (base = 'T') / count(*), 9) AS share_t, round(count(*) FILTER (base = 'N') / count(*), 9) AS share_n FROM b GROUP BY 1, 2""")
def position_quality(spark, d):
    t = rd.position_summary(rd.base_quality(reads(spark, d)))
    return t.select("sample_id", "pos", "bases", *[r(c, 9).alias(c) for c in t.columns[3:]])


@query("a47_read_summary", """
    SELECT sample_id, count(*) AS reads, round(avg(length(seq)), 9) AS mean_length, round(100.0 * sum(length(seq) - length(translate(seq, 'GC', ''))) / sum(length(seq)), 9) AS gc_percent,
           round(100.0 * (count(*) - count(DISTINCT seq)) / count(*), 9) AS duplicate_percent FROM c_reads GROUP BY 1""")
def read_summary(spark, d):
    t = rd.read_summary(reads(spark, d))
    return t.select("sample_id", "reads", *[r(c, 9).alias(c) for c in t.columns[2:]])


@query("a47_length_histogram", "SELECT sample_id, CAST(length(seq) AS INTEGER) AS length, count(*) AS n FROM c_reads GROUP BY 1, 2")
def length_histogram(spark, d):
    return rd.length_histogram(reads(spark, d))


@query("a48_allele_fractions", """
    WITH a AS (SELECT sample_id AS chrom, CAST(split_part(read_id, '_', 2) AS BIGINT) * 80 AS s, seq FROM c_reads),
    b AS (SELECT chrom, s + i - 1 AS pos, seq[i] AS base FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM a)),
    g AS (SELECT chrom, pos, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'C') AS c, count(*) FILTER (base = 'G') AS g, count(*) FILTER (base = 'T') AS t FROM b GROUP BY 1, 2),
    m AS (SELECT *, a + c + g + t AS coverage, list_sort([a, c, g, t], 'DESC')[2] AS minor FROM g)
    SELECT chrom, pos, a, c, g, t, coverage, minor, round(minor / coverage, 9) AS fraction FROM m WHERE coverage >= 20 AND minor >= 4 AND minor / coverage >= 0.1""")
def allele_fractions(spark, d):
    a = reads(spark, d).select(
        F.col("sample_id").alias("chrom"), (F.split_part("read_id", F.lit("_"), F.lit(2)).cast("bigint") * 80).alias("start"), "seq")
    return rd.allele_fractions(a).withColumn("fraction", r("fraction", 9))


@query("a48_allele_fractions_cigar", """
    WITH a AS (SELECT sample_id AS chrom, CAST(split_part(read_id, '_', 2) AS BIGINT) * 80 AS s, seq, CASE WHEN length(seq) < 20 THEN 0 ELSE CAST(split_part(read_id, '_', 1) AS BIGINT) % 4 END AS kind FROM c_reads),
    b AS (SELECT chrom, CASE WHEN kind = 0 THEN s + i WHEN kind = 1 AND i >= 5 THEN s + i - 5 WHEN kind = 2 THEN s + i + CASE WHEN i < 10 THEN 0 ELSE 4 END
                        WHEN kind = 3 AND i < 10 THEN s + i WHEN kind = 3 AND i >= 13 AND i < length(seq) - 2 THEN s + i - 3 END AS pos, seq[i + 1] AS base
          FROM (SELECT *, unnest(range(0, length(seq))) AS i FROM a)),
    g AS (SELECT chrom, pos, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'C') AS c, count(*) FILTER (base = 'G') AS g, count(*) FILTER (base = 'T') AS t FROM b WHERE pos IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT *, a + c + g + t AS coverage, list_sort([a, c, g, t], 'DESC')[2] AS minor FROM g)
    SELECT chrom, pos, a, c, g, t, coverage, minor, round(minor / coverage, 9) AS fraction FROM m WHERE coverage >= 20 AND minor >= 4 AND minor / coverage >= 0.1""")
def allele_fractions_cigar(spark, d):
    """The same reads aligned with clips, deletions and insertions."""
    n = F.length("seq")
    kind = F.when(n < 20, 0).otherwise(F.split_part("read_id", F.lit("_"), F.lit(1)).cast("bigint") % 4)
    cigar = F.when(kind == 1, F.concat(F.lit("5S"), n - 5, F.lit("M"))).when(kind == 2, F.concat(F.lit("10M4D"), n - 10, F.lit("M"))).when(
        kind == 3, F.concat(F.lit("10M3I"), n - 15, F.lit("M2S"))).otherwise(F.concat(n, F.lit("M")))
    a = reads(spark, d).select(
        F.col("sample_id").alias("chrom"), (F.split_part("read_id", F.lit("_"), F.lit(2)).cast("bigint") * 80).alias("start"), "seq", cigar.alias("cigar"))
    return rd.allele_fractions(a).withColumn("fraction", r("fraction", 9))


@query("p35_trim_gaps", """
    WITH p AS (SELECT read_id, sample_id, seq, unnest(range(0, length(seq) - 2)) AS i FROM c_reads),
    o AS (SELECT read_id, seq, i, unnest(range(8, 13)) AS k FROM p),
    w AS (SELECT read_id, i, min(levenshtein('ACGTACGTAC', seq[i + 1:i + k])) AS cost FROM o WHERE i + k <= length(seq) GROUP BY 1, 2),
    h AS (SELECT read_id, i, min(levenshtein(left('ACGTACGTAC', CAST(l AS INTEGER)), seq[i + 1:]) + 2 - l // 5) AS cost FROM (SELECT *, unnest(range(3, 10)) AS l FROM p WHERE length(seq) - i <= 11) GROUP BY 1, 2),
    b AS (SELECT read_id, i, min(cost) AS cost FROM (SELECT * FROM w UNION ALL SELECT * FROM h) WHERE cost <= 2 GROUP BY 1, 2),
    f AS (SELECT *, min(i) OVER (PARTITION BY read_id) AS f FROM b),
    c AS (SELECT read_id, arg_min(i, cost * 1000 + i) AS cut FROM f WHERE i <= f + 2 GROUP BY 1),
    u AS (SELECT r.read_id, sample_id, left(seq, CAST(coalesce(cut, length(seq)) AS INTEGER)) AS seq FROM c_reads r LEFT JOIN c USING (read_id))
    SELECT * FROM u WHERE length(seq) >= 31 AND length(seq) - length(replace(seq, 'N', '')) <= 0.2 * length(seq)""")
def trim_gaps(spark, d):
    """Two edits in the whole adapter, one in a prefix of five bases or more."""
    return rd.trim_reads(reads(spark, d), adapter="ACGTACGTAC", max_n=0.2, errors=0.2, gaps=True).select("read_id", "sample_id", "seq")
