"""The registered queries of this package over the driver tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.llm import (
    bpe, decontaminate, hmm, html_extract, lexical_search, line_dedup, pu_quality, quality_rules, simhash, substring_dedup,
    token_alignment, url_filter, vector_search)
from exprspark.llm.common import table


def bpe_path() -> str:
    """The vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op3_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(table(spark, sf_dir, "documents"))


def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines and n_removed (lines), the digest of the remaining text (of the empty text for null)."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("_text", F.lit("")), 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_documents(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), bpe_path()).drop("token_ids")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
    return vector_search.search(vectors)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the byte-level and the piece tokens of every document, with corpus-wide counts of their pairs."""
    import public_tokenizers

    out = token_alignment.align(table(spark, sf_dir, "documents"), bpe_path(), public_tokenizers.path("piece_bpe_32k.model"))
    return out.drop("pairs", "links")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT dw.doc_id, dw.k, dw.i, bw.item_id FROM dw JOIN bw USING (k, g)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS q FROM (SELECT DISTINCT doc_id, k, i FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP2_SQL = r"""
WITH r(rule, verdict, host, path) AS (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
  ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, u.host, u.path, arg_max(r.rule, length(r.rule)) AS rule, coalesce(arg_max(r.verdict, length(r.rule)), 'allow') AS verdict
FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY page_id, u.host, u.path
"""

OP7_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, j, line AS a, lead(line) OVER o AS b, lead(line, 2) OVER o AS c FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY j)),
r AS (SELECT doc_id, j, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, j) AS nth FROM w WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT r.doc_id, n.i FROM r JOIN n ON n.doc_id = r.doc_id AND n.j BETWEEN r.j AND r.j + 2 WHERE nth > 1),
k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS kept, count(*) AS n FROM l ANTI JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id),
c AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_lines, (coalesce(c.n, 0) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, sum(least(8, coalesce(i - p, 8))) AS n FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r) GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             len(ls)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN c USING (doc_id)),
v AS (SELECT m.*, 1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
             1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 100 * word_chars // greatest(n_words, 1) AS word_length FROM m),
u AS (SELECT lang, source, metric, val FROM v UNPIVOT (val FOR metric IN (symbols, dup_lines, repeats, word_length))),
f AS (SELECT lang, source, metric, CASE WHEN val < 64 THEN val ELSE (val >> (length(bin(val)) - 6)) << (length(bin(val)) - 6) END AS lo FROM u),
lv AS (SELECT 2 AS depth, lang, source, metric, lo FROM f UNION ALL SELECT 1, lang, '', metric, lo FROM f UNION ALL SELECT 0, '', '', metric, lo FROM f),
q AS (SELECT depth, lang, source, metric, count(*) AS total, quantile_disc(lo, 0.25) AS q1, quantile_disc(lo, 0.75) AS q3 FROM lv GROUP BY ALL),
sh AS (SELECT depth, lang, source, metric, total::DOUBLE AS n, q1::DOUBLE AS q1, q3::DOUBLE AS q3,
              sqrt(sum(least(greatest(lo - q3, 0), 100) * least(greatest(lo - q3, 0), 100))::DOUBLE / total) AS tail
       FROM lv JOIN q USING (depth, lang, source, metric) GROUP BY depth, lang, source, metric, total, q1, q3),
bl AS (SELECT a.lang, a.source, a.metric,
              a.n / (a.n + 100) * a.q1 + (1 - a.n / (a.n + 100)) * (b.n / (b.n + 100) * b.q1 + (1 - b.n / (b.n + 100)) * e.q1) AS q1,
              a.n / (a.n + 100) * a.q3 + (1 - a.n / (a.n + 100)) * (b.n / (b.n + 100) * b.q3 + (1 - b.n / (b.n + 100)) * e.q3) AS q3,
              a.n / (a.n + 100) * a.tail + (1 - a.n / (a.n + 100)) * (b.n / (b.n + 100) * b.tail + (1 - b.n / (b.n + 100)) * e.tail) AS tail
       FROM sh a JOIN sh b ON b.depth = 1 AND b.lang = a.lang AND b.metric = a.metric JOIN sh e ON e.depth = 0 AND e.metric = a.metric WHERE a.depth = 2),
lim AS (SELECT lang, source, metric, q3 + 2 * (q3 - q1) + CASE metric WHEN 'word_length' THEN 4 ELSE 8 END * tail AS cut FROM bl),
p AS (PIVOT lim ON metric IN ('symbols', 'dup_lines', 'repeats', 'word_length') USING max(cut) GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND v.symbols <= p.symbols AND v.dup_lines <= p.dup_lines
       AND v.repeats <= p.repeats AND v.word_length <= p.word_length AS kept
FROM v JOIN p USING (lang, source)
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM n),
m AS (SELECT doc_id, 75 + (25 * n * big_n) // l AS m FROM n, c),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d SEMI JOIN i USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, big_n),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM tf JOIN i USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_url_filter": op2_url_filter,
    "op3_hmm_lm": op3_hmm_lm,
    "op4_html_crf": op4_html_crf,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pu_quality": op6_pu_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_hnsw": op12_hnsw,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op2_url_filter": OP2_SQL, "op7_line_dedup": OP7_SQL, "op8_quality_rules": OP8_SQL, "op11_lexical_search": OP11_SQL}
