"""Lexical search, vector search and token alignment: brute force, edge cases and very small bounds."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers
from support import SF
from test_llm_cases import LONG, ROWS, SCHEMA, prose

from exprspark.llm import catalog, lexical_search, token_alignment, vector_search

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None, None, None, 7, None, 1, "x", 2, "t", ["w"]) for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


ITEMS = [
    ("a", prose(60, 3)), ("b", "short ONE one one"), ("c", None), ("d", ""), ("e", "-- ,, !"), ("f", "漢字 it’s ll nothing"), ("g", LONG[:3000]), ("h", "word"),
    (None, prose(20, 7)), ("same", "a b"), ("same", "c d"), ("b", "short ONE one one"), ("zz", "unseen9 terms9 only9"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in ITEMS], "item_id string, text string, rank int, item int, score int, doc_id int")


@pytest.mark.parametrize("block, cells, top", [(500_000, 500_000, 20), (40, 6, 3), (7, 1, 20)])
def test_lexical_search(docs, items, monkeypatch, block, cells, top):
    """Also with items in several blocks, items cut into pieces, and documents scored one by one; ties go to the smaller doc_id."""
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    got = lexical_search.search(docs, items, top, block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (str(r[0]), r[1], r[3], str(r[2]))
    want = brute.lexical(ROWS, list(dict.fromkeys(ITEMS)), top)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert {"c", "d", "e", "zz"}.isdisjoint(r[0] for r in want) and (top < 20 or any(r[2] is None for r in want))


def test_lexical_search_of_nothing(docs, items, none):
    assert lexical_search.search(none, items).count() == 0
    empty = lexical_search.search(docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(docs.filter("text IS NULL"), items).count() == 0


def test_lexical_scores_beyond_doubles():
    """Sums that a double cannot hold are added as whole numbers."""
    index = {"first": np.array([0]), "width": np.array([1]), "item": np.array([0]), "weight": np.array([2**53 + 1]), "items": 1, "exact": False}
    assert lexical_search._score(np.array([0]), np.array([1]), np.array([0]), 1, index).tolist() == [[2**53 + 1]]


def vectors():
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # copies of a query, ties by id
    rows += [(600, None), (610, []), (620, [0.0] * 6), (630, [float("nan")] + [1.0] * 5), (640, [float("inf")] * 6), (650, [None] + [1.0] * 5), (None, [1.0] * 6)]
    rows += [(700, [1.0, 2.0]), (701, [1.0, 2.5]), (710, [1.0, 2.0, 3.0]), (30, rows[30][1]), (40, [9.0] * 6), (55, [-0.0] * 5 + [1.0]), (56, [0.0] * 5 + [1.0])]
    return rows


@pytest.mark.parametrize("kind, shard_bytes", [("float", 1 << 20), ("double", 2000)])
def test_vector_search(spark, kind, shard_bytes):
    """Small shards are searched whole, so the result is exact: also for copies, ties, other lengths and vectors that take no part."""
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, vec array<{kind}>, rank int, dim int")
    got = [tuple(r) for r in vector_search.search(df, every=10, k=10, shard_bytes=shard_bytes).collect()]
    want = brute.nearest(rows, 10, 10)
    assert sorted(g[:3] for g in got) == sorted(w[:3] for w in want)
    np.testing.assert_allclose([g[3] for g in sorted(got)], [w[3] for w in sorted(want)], rtol=1e-12, atol=1e-12)
    assert Counter(g[0] for g in got)[700] == 1 and 710 not in {g[0] for g in got}
    assert vector_search.search(df.limit(0)).count() == 0


def test_vector_graph_recall_in_hard_directions():
    """A graph of several levels, without clusters to lead the way; links never point outside, slots stay filled from the left."""
    r = np.random.default_rng(5)
    points = r.normal(size=(6000, 24)).astype(np.float32)
    levels = np.array([vector_search._level(p.tobytes()) for p in points])
    points = points[np.argsort(-levels, kind="stable")]
    counts = [int((levels >= h).sum()) for h in range(levels.max(), -1, -1)]
    assert len(counts) > 2 and counts[-1] == 6000 and 250 < counts[-2] < 500
    index = vector_search.Index.build(points, counts)
    queries = points[r.choice(6000, 200, replace=False)]
    found = index.search(queries, vector_search.WIDTH)
    true = np.argsort(((queries[:, None] - points) ** 2).sum(-1), axis=1)[:, :11]
    assert np.mean([len(set(f[:11]) & set(t)) for f, t in zip(found.tolist(), true.tolist())]) / 11 > 0.95
    links = index.graphs[-1].links
    assert links.max() < 6000 and ((links[:, 1:] >= 0) <= (links[:, :-1] >= 0)).all() and ((links >= 0).sum(axis=1) > 0).all()


def test_op12(spark):
    """Recall of the registered query against all distances, and exact scores."""
    table = pq.read_table(f"{SF}/embeddings.parquet")
    ids, v = table.column("vec_id").to_numpy(), np.array(table.column("embedding").to_pylist(), dtype=np.float64)
    found = {}
    for r in catalog.QUERIES["op12_hnsw"](spark, SF).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits, queries = 0, np.flatnonzero(ids % 100 == 0)
    assert set(found) == set(ids[queries].tolist())
    for q in queries:
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        mine = sorted(found[ids[q]])
        assert [m[0] for m in mine] == list(range(1, 11)) and [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        at = {int(i): float(x) for i, x in zip(ids, d)}
        assert all(m[2] == pytest.approx(at[m[1]], rel=1e-12) for m in mine)
        hits += len({m[1] for m in mine} & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(queries)


def alignment_texts():
    r = random.Random(3)
    odd = ["a", " ", "  two  spaces\n\n\n x", "a▁b", "nul\x00x", "<|endoftext|> <s> 'll it’s", "\u200b\u0301e\ufeff", " " * 50 + "x", "aaaaaaa" * 100, " " * 5000 + "end", "漢字" * 400]
    return odd + ["".join(r.choices("abc ñé漢😀\n\t ", k=r.randint(1, 200))) for _ in range(40)]


@pytest.mark.parametrize("segment, expanded, head", [(200_000, 1_000_000, 1 << 18), (100, 50, 20), (1, 1, 1)])
def test_token_alignment(spark, monkeypatch, segment, expanded, head):
    """Also with texts cut into segments, products in pieces, and all but a few pairs joined instead of broadcast."""
    monkeypatch.setattr(token_alignment, "SEGMENT", segment)
    monkeypatch.setattr(token_alignment, "EXPANDED", expanded)
    texts = [t[:600] if t and segment < 1000 else t for _, t in ROWS] + alignment_texts()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, row int, pairs int")
    got = token_alignment.align(docs, *PATHS, head=head)
    want = brute.alignment(texts, *PATHS)
    rows = {r["doc_id"]: r for r in got.collect()}
    names = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [tuple(rows[i][n] for n in names) for i in range(len(texts))] == want
    assert all(sum(r["links"]) == r["n_links"] for r in rows.values())


def test_token_alignment_of_nothing(docs, none, spark):
    assert token_alignment.align(none, *PATHS).count() == 0
    got = token_alignment.align(docs.filter("doc_id IS NULL"), *PATHS).collect()
    assert sorted(r["n_a"] > 0 for r in got) == [False, True] and all(r["doc_id"] is None for r in got)


def test_op13(spark):
    texts = pq.read_table(f"{SF}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op13_token_alignment"](spark, SF).collect()}
    names = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = brute.alignment([t["text"] for t in texts], *PATHS)
    assert [tuple(rows[t["doc_id"]][n] for n in names) for t in texts] == want
