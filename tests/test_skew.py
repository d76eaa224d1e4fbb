"""A third of all rows on one key, value or spot; results stay whole and equal to brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from exprspark.operators import explore, intervals as iv
from exprspark.operators import cells as cl
from exprspark.operators import normalize


def test_stacked_intervals_and_reads(spark):
    rng = np.random.default_rng(0)
    f = [(f"x{i}", 500, 600) for i in range(40)] + [(f"y{i}", int(a), int(a) + int(n)) for i, (a, n) in enumerate(zip(rng.integers(0, 2000, 40), rng.integers(1, 60, 40)))]
    r = [(550, 560)] * 300 + [(int(a), int(a) + int(n)) for a, n in zip(rng.integers(0, 2000, 600), rng.integers(1, 80, 600))]
    feats = spark.createDataFrame([(i, "c", a, b) for i, a, b in f], "interval_id string, chrom string, start long, end long")
    reads = spark.createDataFrame([("s", "c", a, b) for a, b in r], "sample_id string, chrom string, start long, end long")
    want: dict = {}
    for a, b in r:
        hits = [i for i, x, y in f if x < b and y > a]
        key = ("no_feature", None) if not hits else ("assigned", hits[0]) if len(hits) == 1 else ("ambiguous", None)
        want[key] = want.get(key, 0) + 1
    got = {(x["status"], x["interval_id"]): x["n"] for x in iv.count_overlaps(reads, feats, tile=100).collect()}
    assert got == want


def test_adjacent_intervals_swap_codes(spark):
    feats = spark.createDataFrame([("x", "c", 0, 10), ("y", "c", 10, 20)], "interval_id string, chrom string, start long, end long")
    reads = spark.createDataFrame([("s", "c", 9, 10), ("s", "c", 10, 11), ("s", "c", 9, 11)], "sample_id string, chrom string, start long, end long")
    got = {(x["status"], x["interval_id"]): x["n"] for x in iv.count_overlaps(reads, feats).collect()}
    assert got == {("assigned", "x"): 1, ("assigned", "y"): 1, ("ambiguous", None): 1}


def test_duplicates_of_one_signature(spark):
    rows = [(f"r{i:04d}", "s", "c", 100, 150, "+", 0) for i in range(400)] + [(f"q{i:04d}", "s", "c", i, i + 50, "-", 0) for i in range(800)]
    df = spark.createDataFrame(rows, "read_id string, sample_id string, chrom string, start long, end long, strand string, flag int")
    assert iv.mark_duplicates(df).filter("is_duplicate").count() == 399
    assert iv.deduplicate(df).filter("strand = '+'").first()["read_id"] == "r0000"


def test_gram_in_many_tiles_and_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.poisson(0.7, (50, 11)).astype(float)
    x[:, 0] = 3  # a third of the entries sit in a few samples
    f, s = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "sample_id": [f"s{j:02d}" for j in s], "v": x[f, s]}))
    gram, ids = explore.sample_gram(df, "v", tile=3, block=7)
    got = np.zeros((11, 11))
    for r in gram.collect():
        got[r["i"], r["j"]] = r["dot"]
    np.testing.assert_allclose(got, np.triu(x.T @ x))
    assert [r["sample_id"] for r in ids.orderBy("idx").collect()] == sorted({f"s{j:02d}" for j in s})


def test_pca_equals_a_singular_value_decomposition(spark):
    rng = np.random.default_rng(2)
    x = rng.poisson(rng.gamma(1, 3, (60, 1)) * rng.gamma(5, 0.2, (1, 7))).astype(float)
    f, s = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "sample_id": [f"s{j}" for j in s], "v": x[f, s]}))
    for mode in ("sample", "feature"):
        if mode == "sample":
            z = ((x - x.mean(0)) / x.std(0, ddof=1)).T
        else:
            keep = x.std(1) > 0
            z = (x[keep] / x[keep].std(1, ddof=1)[:, None]).T
        z = z - z.mean(0)
        u, d, _ = np.linalg.svd(z, full_matrices=False)
        scores, importance = explore.pca_samples(df, "v", 3, 60, scale=mode)
        got = scores.toPandas().pivot(index="sample_id", columns="pc", values="score").to_numpy()
        np.testing.assert_allclose(np.abs(got), np.abs(u[:, :3] * d[:3]), atol=1e-6)
        np.testing.assert_allclose(importance.toPandas()["proportion"], (d**2 / (d**2).sum())[:3], atol=1e-9)


def test_pca_of_more_samples_than_directions(spark):
    """Components come from the executors in several rounds, equal to a singular value decomposition."""
    rng = np.random.default_rng(4)
    x = rng.poisson(rng.gamma(1, 3, (80, 1)) * rng.gamma(5, 0.2, (1, 60)) * np.exp(0.5 * rng.normal(size=(80, 3)) @ rng.normal(size=(3, 60)))).astype(float)
    f, s = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "sample_id": [f"s{j:02d}" for j in s], "v": x[f, s]}))
    for mode in ("sample", "feature"):
        full = np.vstack([x, np.zeros((5, 60))])  # five features are absent everywhere
        if mode == "sample":
            z = ((full - full.mean(0)) / full.std(0, ddof=1)).T
        else:
            z = (x[x.std(1) > 0] / x[x.std(1) > 0].std(1, ddof=1)[:, None]).T
        u, d, _ = np.linalg.svd(z - z.mean(0), full_matrices=False)
        scores, importance = explore.pca_samples(df, "v", 3, 85, scale=mode)
        got = scores.toPandas().pivot(index="sample_id", columns="pc", values="score").to_numpy()
        np.testing.assert_allclose(np.abs(got), np.abs(u[:, :3] * d[:3]), atol=1e-5)
        assert (got[np.abs(got).argmax(axis=0), range(3)] > 0).all()
        np.testing.assert_allclose(importance.toPandas()["proportion"], (d**2 / (d**2).sum())[:3], rtol=1e-8)


def test_markers_with_a_hot_value_equal_the_rank_sum(spark):
    rng = np.random.default_rng(3)
    n = 200
    x = np.where(rng.random((6, n)) < 0.4, 0, rng.integers(1, 9, (6, n)).astype(float))
    x[0, :70] = 2.0
    lab = np.where(np.arange(n) % 3 == 0, "A", "B")
    f, c = np.nonzero(x)
    m = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "cell_id": [f"c{j}" for j in c], "value": x[f, c]}))
    cells = spark.createDataFrame(pd.DataFrame({"cell_id": [f"c{j}" for j in range(n)], "cluster": lab}))
    got = cl.find_markers(m, cells, min_pct=0.0, min_log_fc=-99.0).toPandas().set_index(["feature_id", "cluster"])
    for i in range(6):
        r = pd.Series(x[i]).rank().to_numpy()
        for k in "AB":
            n1 = (lab == k).sum()
            assert got.loc[(f"f{i}", k), "u"] == r[lab == k].sum() - n1 * (n1 + 1) / 2


def test_residual_variance_counts_absent_cells(spark):
    rng = np.random.default_rng(4)
    x = rng.poisson(0.5, (8, 60)).astype(float)
    x[:, x.sum(0) == 0] = 1
    f, c = np.nonzero(x)
    m = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "cell_id": [f"c{j}" for j in c], "count": x[f, c]}))
    cells = spark.createDataFrame(pd.DataFrame({"cell_id": [f"c{j}" for j in range(60)], "sample_id": "s"}))
    mu = np.outer(x.sum(1), x.sum(0)) / x.sum()
    z = np.clip((x - mu) / np.sqrt(mu + mu**2 / 100), -np.sqrt(60), np.sqrt(60))
    got = cl.residual_variance(m, cells).toPandas().set_index("feature_id")["variance"]
    for i in range(8):
        assert abs(got[f"f{i}"] - z[i].var(ddof=1)) < 1e-9


def test_densify_keeps_all_samples(spark):
    v = spark.createDataFrame([("f", "a", 1.0)], "feature_id string, sample_id string, count double")
    s = spark.createDataFrame([(x,) for x in "abc"], "sample_id string")
    got = {r["sample_id"]: r["count"] for r in normalize.densify(v, "count", s).collect()}
    assert got == {"a": 1.0, "b": 0.0, "c": 0.0}
    assert normalize.row_zscore(v, "count", 3).select(F.round("z", 6)).first()[0] == 1.154701


def test_correlation_lists_pairs_without_a_common_feature(spark):
    """All pairs of samples are returned, also those whose products are absent or cancel; several tiles and blocks."""
    rng = np.random.default_rng(6)
    x = np.zeros((40, 23))
    for f in range(40):
        group = rng.choice(12, 3, replace=False) + (11 if f % 2 else 0)  # two halves that share no feature but the last ones
        x[f, group] = rng.integers(1, 9, 3)
    x[0, :12] = 2
    f, s = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "sample_id": [f"s{j:02d}" for j in s], "v": x[f, s]}))
    want = np.corrcoef(x.T)
    for tile, block in ((None, 4096), (5, 7), (4, 3)):
        got = explore.sample_correlation(df, "v", 40, tile=tile, block=block).toPandas()
        assert len(got) == 23 * 22 // 2 and not got.duplicated(["sample_1", "sample_2"]).any()
        i, j = (got[c].str[1:].astype(int).to_numpy() for c in ("sample_1", "sample_2"))
        assert (i < j).all() and ((x.T @ x)[i, j] == 0).any()
        np.testing.assert_allclose(got["correlation"], want[i, j], atol=1e-12)
