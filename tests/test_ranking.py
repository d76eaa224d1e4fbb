"""Ranks, quantiles and adjustment against numpy, with few and with many tiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from exprspark.operators.ranking import (
    average_rank, bh_adjust, exact_quantiles, ordered_index, sweep, value_ranks)


def bh(p):
    n, o = len(p), np.argsort(p)
    q = np.minimum.accumulate((p[o] * n / np.arange(1, n + 1))[::-1])[::-1]
    out = np.empty(n)
    out[o] = np.minimum(q, 1)
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 3000
    p = np.round(rng.random(n) ** 3, 3)
    p[: n // 3] = 1.0  # one value holds a third of all rows
    g = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 5, n))
    pdf = pd.DataFrame({"id": range(n), "g": g, "p": p})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("tiles", [2, 64])
def test_bh(data, tiles):
    pdf, df = data
    got = bh_adjust(df, "p", tiles=tiles).toPandas().sort_values("id")
    np.testing.assert_allclose(got["fdr"], bh(pdf["p"].to_numpy()))
    assert (got["fdr"] >= got["p"]).all()
    by = bh_adjust(df, "p", ["g"], tiles=tiles).toPandas().sort_values("id")
    np.testing.assert_allclose(by["fdr"], pdf.groupby("g")["p"].transform(lambda x: bh(x.to_numpy())))


def test_bh_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, 0.01), (2, None), (3, 0.04), (4, float("nan"))], "id int, p double")
    got = {r["id"]: r["fdr"] for r in bh_adjust(df, "p").collect()}
    assert got == {1: 0.02, 2: None, 3: 0.04, 4: None}


@pytest.mark.parametrize("tiles", [2, 64])
def test_quantiles_and_ranks(data, tiles):
    pdf, df = data
    q = exact_quantiles(df, ["g"], "p", {"a": 0.1, "b": 0.75}, tiles=tiles).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["p"].quantile([0.1, 0.75]).unstack()
    np.testing.assert_allclose(q[["a", "b"]], want)
    r = value_ranks(df, [], "p", tiles=tiles).toPandas()
    assert r["n"].sum() == len(pdf) and (r["below"] + r["n"]).max() == len(pdf)


def test_weighted_quantile_counts_zeros(spark):
    df = spark.createDataFrame([("s", 0.0, 5), ("s", 4.0, 1), ("s", 8.0, 2)], "s string, v double, w long")
    got = exact_quantiles(df, ["s"], "v", {"q": 0.75}, weight="w").first()["q"]
    assert got == np.quantile([0] * 5 + [4, 8, 8], 0.75)


def test_ordered_index_and_average_rank(data):
    pdf, df = data
    got = ordered_index(df, [F.col("p"), F.col("id")], by=["g"]).toPandas().set_index("id")["rank"].sort_index()
    want = pdf.sort_values(["g", "p", "id"]).groupby("g").cumcount().sort_index() + 1
    assert (got == want).all()
    avg = average_rank(df, "p").toPandas().sort_values("id")["avg_rank"]
    np.testing.assert_allclose(avg, pdf["p"].rank())


def test_same_result_for_any_partitioning(spark, data):
    _, df = data
    out = []
    for n in (1, 37):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, bh_adjust(df.repartition(n), "p", ["g"], tiles=8).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert out[0] == out[1]


@pytest.mark.parametrize("tile", [3, 50, 1 << 20])
def test_sweep_carries_over_tiles(spark, tile):
    rng = np.random.default_rng(1)
    pos = rng.integers(0, 300, 500)
    delta = rng.choice([-1, 1], 500)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "pos": pos, "d": delta}))
    seg = sweep(df, ["k"], ["d"], tile=tile).toPandas().sort_values("start")
    depth = np.zeros(301)
    np.add.at(depth, pos, delta)
    depth = depth.cumsum()
    for _, row in seg.iterrows():
        assert (depth[row["start"] : row["end"]] == row["d"]).all()
    assert (seg["end"].to_numpy()[:-1] == seg["start"].to_numpy()[1:]).all()
