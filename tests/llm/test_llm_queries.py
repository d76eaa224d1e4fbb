"""The registered queries of the package on the given tables, against SQL or brute force."""

import hashlib
import math
import os
import zlib
from collections import Counter

import brute
import duckdb
import pyarrow.parquet as pq
import pytest
from support import SF, spark_result, sql_result

import corpus_pipeline
from exprspark.llm import catalog, html_blocks


def documents(name="documents"):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def collected(spark, name):
    return {r["doc_id"]: r for r in catalog.QUERIES[name](spark, SF).collect()}


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog.bpe_path())


def encoded(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql(spark, name):
    assert spark_result(catalog.QUERIES[name](spark, SF)) == sql_result(catalog.ORACLES[name], SF)


def test_op3(spark):
    rows = collected(spark, "op3_hmm_lm")
    words = {r["doc_id"]: [w.lower() for w in brute.split(r["text"])] + [b""] for r in documents()}
    count = Counter(w for d, ws in words.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    total, norm = sum(count.values()), math.log10(sum(count.values()) + 0.1 * (len(count) + 1))
    assert rows.keys() == words.keys()
    model = base = 0
    for d, ws in words.items():
        r = rows[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in count for w in ws), total)
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 10 == 0)
        assert r["base_score"] == pytest.approx(sum(math.log10(count[w] + 0.1) - norm for w in ws), rel=1e-9)
        if r["held_out"]:
            model, base = model + r["score"], base + r["base_score"]
    assert model > base  # of unseen texts


def test_op4(spark):
    pages = {r["page_id"]: r for r in documents("pages")}
    rows = catalog.QUERIES["op4_html_crf"](spark, SF).collect()
    assert len(rows) == len(pages)
    there = found = given = 0
    for r in rows:
        page = pages[r["page_id"]]["html"]
        want = [b.text for b in html_blocks.blocks(page[page.index("<article>"):page.index("</article>")])]
        lines = r["text"].split("\n")
        there, given, found = there + sum(map(len, want)), given + sum(map(len, lines)), found + sum(len(x) for x in lines if x in want)
    assert found >= 0.95 * there and found >= 0.95 * given
    for r in rows:
        page = pages[r["page_id"]]["html"]
        article = page[page.index("<article>"):page.index("</article>")]
        assert r["n_chars"] == len(r["text"])
        for outside in (page[:page.index("<article>")], page[page.index("</article>"):]):
            assert not any(len(x) > 60 and x in outside for x in r["text"].split("\n") if x not in article)


def test_op5(spark):
    want = brute.repeated_words([(r["doc_id"], r["text"]) for r in documents()])
    rows = collected(spark, "op5_substring_dedup")
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in rows.items()} == {
        d: (n, n - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for d, (n, k) in want.items()}


def test_op6(spark):
    """On the next larger tables: the smallest hold a single unseen label 0."""
    folder = f"{os.path.dirname(SF)}/sf0.01"
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op6_pu_quality"](spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    assert len(rows) == pq.read_metadata(f"{folder}/documents.parquet").num_rows
    held = [(r["score"], labels[d]) for d, r in rows.items() if d in labels and zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for d, r in rows.items())
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert len(pairs) > 500 and sum(pairs) / len(pairs) > 0.95


def test_op9(spark):
    fps = [(r["doc_id"], brute.simhash(r["text"])) for r in documents()]
    roots = brute.components(fps)
    rows = collected(spark, "op9_simhash")
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in rows.items()} == {d: (f"{f:016x}", roots[d]) for d, f in fps}


def test_op10(spark):
    t, rows = tokenizer(), collected(spark, "op10_bpe")
    assert {d: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for d, r in rows.items()} == {r["doc_id"]: encoded(t, r["text"]) for r in documents()}


def test_pipeline(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({catalog.ORACLES['op8_quality_rules']}) WHERE kept").fetchall()}
    docs = [(r["doc_id"], r["text"]) for r in documents() if r["doc_id"] in kept]
    docs = [(d, "\n".join(x)) for d, x in brute.repeated_lines(docs).items()]
    roots = brute.components([(d, brute.simhash(t)) for d, t in docs])
    docs = [(d, t) for d, t in docs if roots[d] == d]
    hits = brute.contaminated(docs, [(r["item_id"], r["text"]) for r in documents("benchmark")])
    t = tokenizer()
    want = {d: encoded(t, x) for d, x in docs if not hits[d][0]}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == want
    assert len(rows) == len(want) and all(len(r["token_ids"]) == r["n_tokens"] for r in rows)
