"""Work that must not grow faster than its input."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from exprspark.catalog import files
from exprspark.operators import cells, clean, de, explore, intervals, network, ranking


def test_gram_of_a_sparse_matrix_copies_no_row_to_all_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.zeros((40, 60))
    for f in range(40):
        x[f, rng.choice(60, 3, replace=False)] = rng.integers(1, 9, 3)
    x[0] = 2  # one feature is in all samples
    f, s = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i}" for i in f], "sample_id": [f"s{j:02d}" for j in s], "v": x[f, s]}))
    dealt, spread = [], explore.spread

    def counted(rows, *cols, **more):
        dealt.append(rows.count())
        return spread(rows, *cols, **more)

    monkeypatch.setattr(explore, "spread", counted)
    gram, _ = explore.sample_gram(df, "v", tile=5)
    got = np.zeros((60, 60))
    for r in gram.collect():
        got[r["i"], r["j"]] = r["dot"]
    np.testing.assert_allclose(got, np.triu(x.T @ x))
    assert dealt[0] == 60 * 12  # the dense feature alone; all rows were copied to 12 tiles before


def test_nb_fit_reads_absent_pairs_from_a_table():
    """What a feature costs depends on its counts, not on the libraries; the sums equal those over all libraries."""
    rng = np.random.default_rng(3)
    lib = rng.lognormal(8, 2, 5000)
    sums = de._Sums(lib)
    t = np.r_[np.linspace(-80, 40, 500), -700.0]
    z = np.exp(t)[:, None] * lib
    value, slope = sums.at(t)
    np.testing.assert_allclose(value, np.log1p(z).sum(axis=1), rtol=1e-11)
    np.testing.assert_allclose(slope, (z / (1 + z)).sum(axis=1), rtol=1e-11)
    y = np.zeros((4, 5000))
    y[0, :7], y[1, 3], y[2, ::2] = rng.integers(1, 90, 7), 5, 4
    row, at = np.nonzero(y)
    for phi in (1e-4, 0.3, 10.0):
        beta, ll, weight = de._fit_rate(de._Counts(4, row, y[row, at], lib[at]), sums, np.full(4, phi))
        mu = np.exp(beta)[:, None] * lib
        score = ((y - mu) / (1 + phi * mu)).sum(axis=1)
        np.testing.assert_allclose(score[:3] / y[:3].sum(axis=1), 0, atol=1e-8)
        assert beta[3] == -700
        plain = y.sum(axis=1) * np.where(beta > -700, beta, 0) + y @ np.log(lib) - ((y + 1 / phi) * np.log1p(phi * mu)).sum(axis=1)
        np.testing.assert_allclose(ll, plain, rtol=1e-9)
        np.testing.assert_allclose(weight, (mu / (1 + phi * mu)).sum(axis=1), rtol=1e-9)


def test_lines_of_one_sample_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 5).select(F.lit("s").alias("sample_id"), F.col("id"))
    files.per_sample_text(rows, F.concat_ws("\t", F.lit("r"), "id"), str(tmp_path / "t"), F.lit("@HD\tVN:1.6"), parts=True)
    back = spark.read.text(str(tmp_path / "t")).select("value", F.col("_metadata.file_name").alias("f")).toPandas()
    assert sorted(back["value"]) == sorted(["@HD\tVN:1.6", *(f"r\t{i}" for i in range(1000))])
    assert back["f"].nunique() == 6 and back["f"].min() == back["f"][back["value"] == "@HD\tVN:1.6"].item()
    assert back.groupby("f").size().max() <= 200  # one task wrote all lines of a sample before


def test_annotated_values_gather_no_joined_rows(spark):
    """Repeated rows on either side are one, and the joined rows are not shuffled to find that out."""
    v = spark.createDataFrame([("f", "s", 1.0), ("f", "s", 1.0), ("f", "t", 1.0), (None, "s", 2.0), ("g", "s", 3.0)], "feature_id string, sample_id string, count double")
    a = spark.createDataFrame([("f", "x", None), ("f", "x", None), ("f", "y", "b"), (None, "z", "c")], "feature_id string, symbol string, biotype string")
    got = clean.with_annotations(v, a)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted([("f", t, 1.0, *s) for t in "st" for s in (("x", None), ("y", "b"))], key=key)
    top = got._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    assert not top.startswith("Aggregate")


def test_sparse_intervals_get_wide_tiles(spark):
    """Tiles of a few positions over far apart intervals are as many as the intervals; few intervals keep the asked width."""
    x = spark.range(5000).select(F.lit("c").alias("chrom"), (F.col("id") * 1000).alias("start"), (F.col("id") * 1000 + 30 + F.col("id") % 2 * 980).alias("end"))
    assert intervals._width(x, ["chrom"], 16) > 500_000
    assert intervals._width(x.limit(100), ["chrom"], 16) == 16
    assert intervals._width(x, ["chrom"], 1 << 22) == 1 << 22
    got = [tuple(r) for r in intervals.merge_intervals(x, ["chrom"], tile=16).orderBy("start").collect()]
    assert got == [("c", 0, 30)] + [("c", i * 1000, (i + 1) * 1000 + 30) for i in range(1, 4998, 2)] + [("c", 4_999_000, 5_000_010)]


def _staged_rows(monkeypatch):
    rows, stage = [], intervals.stage

    def counted(df):
        out = stage(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(intervals, "stage", counted)
    return rows


def _reads_and_features(spark):
    reads = spark.range(4000).select(F.lit("s").alias("sample_id"), F.concat(F.lit("r"), F.col("id") % 3000).alias("read_id"), F.lit("c").alias("chrom"),
                                     (F.col("id") * 5).alias("start"), (F.col("id") * 5 + 7).alias("end"))
    return reads, spark.createDataFrame([(f"f{i}", "c", i * 400, i * 400 + 90) for i in range(50)], "interval_id string, chrom string, start long, end long")


def test_records_of_fragments_are_written_and_joined_nowhere(spark, monkeypatch):
    rows = _staged_rows(monkeypatch)
    reads, features = _reads_and_features(spark)
    got = intervals.count_overlaps(reads, features, by_pair=True)
    assert sum(rows) < 1000  # places, what they met and the running sums at both ends of each were written before, 16,000 rows
    assert got.agg(F.sum("n")).first()[0] == 3000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the names of the codes; the records were joined to what their places met before


def test_a_read_is_looked_up_once(spark, monkeypatch):
    rows = _staged_rows(monkeypatch)
    reads, features = _reads_and_features(spark)
    got = intervals.count_overlaps(reads, features)
    assert sum(rows) < 4000 + 1000  # the distinct reads; the running sums at both ends of each were written too before
    assert got.agg(F.sum("n")).first()[0] == 4000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # two lookups were two more


def test_tiles_of_few_features_do_not_grow_with_the_sequence(spark, monkeypatch):
    rows = _staged_rows(monkeypatch)
    at = spark.range(5000).select("id", F.lit("c").alias("chrom"), (F.col("id") * (1 << 20)).alias("start"))
    features = at.select(F.concat(F.lit("f"), "id").alias("interval_id"), "chrom", "start", (F.col("start") + 90).alias("end"))
    from_, to = F.when(F.col("id") % 3 == 1, 90).otherwise(50), F.when(F.col("id") % 3 == 2, (1 << 20) + 10).otherwise(100)
    reads = at.select(F.lit("s").alias("sample_id"), "chrom", (F.col("start") + from_).alias("start"), (F.col("start") + to).alias("end"))
    got = intervals.count_overlaps(reads, features)
    assert rows[-1] < 10  # tiles with what earlier ones end with; one for each feature before
    want = {("s", "assigned", f"f{i}"): 1 for i in range(0, 5000, 3)} | {("s", "no_feature", None): 1667, ("s", "ambiguous", None): 1666}
    assert {(r["sample_id"], r["status"], r["interval_id"]): r["n"] for r in got.collect()} == want


def test_a_query_travels_to_a_group_of_pivots_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    ref, q = rng.normal(size=(1500, 12)), rng.normal(size=(40, 12))  # bounds that close hardly any pivot
    frame = lambda x, t: spark.createDataFrame([(f"{t}{i:04d}", v.tolist()) for i, v in enumerate(x)], "cell_id string, vec array<double>")
    sent, spread = [], cells.spread

    def counted(rows, *cols, **more):
        if "pivots" in rows.columns:
            sent.append(rows.count())
        return spread(rows, *cols, **more)

    monkeypatch.setattr(cells, "spread", counted)
    got = cells.knn(frame(q, "q"), frame(ref, "r"), 5, pivots=60, block=500).toPandas()
    d = np.round(np.sqrt(((q[:, None] - ref[None]) ** 2).sum(-1)), 9)
    for i in range(40):
        want = sorted((d[i, j], f"r{j:04d}") for j in range(1500))[:5]
        assert list(got[got["query_id"] == f"q{i:04d}"].sort_values("place")["ref_id"]) == [w[1] for w in want]
    assert sent[0] == 40 and sent[1] <= 40 * 6  # it went to each of up to 59 pivots before


def test_pca_of_samples_without_a_gap_takes_few_rounds(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(260, 400)) * (rng.random((260, 400)) < 0.4)
    s, f = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{j}" for j in f], "sample_id": [f"s{i:03d}" for i in s], "v": x[s, f]}))
    staged, stage = [], explore.stage
    monkeypatch.setattr(explore, "stage", lambda rows: staged.append(1) or stage(rows))
    scores, importance = explore.pca_samples(df, "v", 3, 400, scale="sample")
    z = (x - x.mean(axis=1, keepdims=True)) / x.std(axis=1, ddof=1, keepdims=True)
    u, d, _ = np.linalg.svd(z - z.mean(axis=0), full_matrices=False)
    got = importance.orderBy("pc").toPandas()
    np.testing.assert_allclose(got["sdev"], d[:3] / np.sqrt(259), rtol=1e-9)
    np.testing.assert_allclose(got["proportion"], d[:3] ** 2 / (d**2).sum(), rtol=1e-9)
    wide = scores.toPandas().pivot(index="sample_id", columns="pc", values="score").to_numpy()
    np.testing.assert_allclose(np.abs(wide), np.abs(u[:, :3] * d[:3]), atol=1e-4)
    assert len(staged) < 30  # 85 before: more rounds, and more tables in each


def test_few_pairs_of_near_rows_are_measured_one_by_one():
    """A matrix product tells which pairs may be near; ties, copies and what is not a number stay in."""
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(50, 32)), rng.normal(size=(2000, 32))
    b[7] = b[3] = a[0]
    b[11] = np.nan
    exact = np.round(np.sqrt(((b - a[:, None]) ** 2).sum(-1)), 9)
    for limit in (np.full(50, np.inf), np.sort(exact, axis=1)[:, 2]):
        one, at = cells._within(a, b, 5, limit)
        kept = set(zip(one.tolist(), at.tolist()))
        assert len(kept) < 50 * 8 and all((i, 11) in kept for i in range(50))  # all 100,000 pairs were measured before
        for i in range(50):
            need = np.flatnonzero(exact[i] <= min(np.sort(exact[i])[4], limit[i]))
            assert all((i, j) in kept for j in need.tolist())
    assert len(cells._within(a, b, 5, np.zeros(50))[0]) == 52  # two copies of the first, and a pair of each with the row of NaN


def test_only_large_groups_are_cut_into_tiles(spark, monkeypatch):
    x = pd.DataFrame({"g": ["a"] * 300 + ["b"] * 5, "v": [float(i * 37 % 300) for i in range(300)] + [3.0, 1.0, 4.0, 1.0, 5.0]})
    monkeypatch.setattr(ranking, "FEW", 50)
    df = spark.createDataFrame(x)
    tiles = {r["g"]: r["n"] for r in ranking.value_ranks(df, ["g"], "v").groupBy("g").agg(F.count_distinct("tile").alias("n")).collect()}
    assert tiles["a"] > 10 and tiles["b"] == 1  # the five values of b had tiles of their own before
    got = ranking.exact_quantiles(df, ["g"], "v", {"q": 0.3}).toPandas().set_index("g")["q"]
    for g in "ab":
        np.testing.assert_allclose(got[g], np.quantile(x["v"][x["g"] == g], 0.3))


def test_the_smaller_set_of_a_candidate_gives_its_members(spark):
    rows = [("big", f"f{i}") for i in range(400)] + [(f"small{j}", f"f{i}") for j in range(6) for i in range(j * 40, j * 40 + 40)]
    edges, _ = network.term_similarity(spark.createDataFrame(rows, "term_id string, feature_id string"), 0.05)
    assert sorted(tuple(r) for r in edges.collect()) == [("big", f"small{j}", 40, 0.1) for j in range(6)]
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert "_small" in plan and "_large" in plan  # "big" gave its 400 members to each of six candidates before


def test_pca_of_many_samples_keeps_directions(spark, monkeypatch):
    """Where few directions are iterated at once, many are kept, so that close eigenvalues take fewer rounds; blocks are not moved again."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 600)) * (rng.random((400, 600)) < 0.3)
    s, f = np.nonzero(x)
    df = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{j}" for j in f], "sample_id": [f"s{i:03d}" for i in s], "v": x[s, f]}))
    rounds, stage = [], explore.stage
    monkeypatch.setattr(explore, "stage", lambda rows: rounds.append(rows.columns == ["tile", "q", "u"]) or stage(rows))
    monkeypatch.setattr(explore, "DIRECTIONS", 0)
    scores, importance = explore.pca_samples(df, "v", 3, 600, scale="sample")
    z = (x - x.mean(axis=1, keepdims=True)) / x.std(axis=1, ddof=1, keepdims=True)
    d = np.linalg.svd(z - z.mean(axis=0), compute_uv=False)
    np.testing.assert_allclose(importance.orderBy("pc").toPandas()["sdev"], d[:3] / np.sqrt(399), rtol=1e-9)
    assert scores.count() == 1200
    assert 5 < sum(rounds) < 24  # 27 before


def test_neighbour_vectors_are_copied_a_bounded_number_of_times(spark, monkeypatch):
    """Groups grow with the table: a vector without near neighbours travels to 16 groups or so, not to one for each few blocks."""
    rng = np.random.default_rng(10)
    v = rng.normal(size=(600, 24))
    df = spark.createDataFrame(pd.DataFrame({"cell_id": [f"c{i:03d}" for i in range(600)], "vec": v.tolist()}))
    dealt, spread = [], cells.spread

    def counted(rows, *cols, **more):
        dealt.append(rows.count())
        return spread(rows, *cols, **more)

    monkeypatch.setattr(cells, "spread", counted)
    monkeypatch.setattr(cells, "FOUND", 100, raising=False)
    got = cells.knn(df, df, 4, block=2).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("place", "ref_id", "distance"))).alias("n")).toPandas()
    d = np.round(np.sqrt(((v[:, None] - v) ** 2).sum(axis=2)), 9)
    for q, n in zip(got["query_id"], got["n"]):
        best = np.argsort(d[int(q[1:])], kind="stable")[:4]
        assert [r["ref_id"] for r in n] == [f"c{i:03d}" for i in best]
        np.testing.assert_allclose([r["distance"] for r in n], d[int(q[1:])][best], atol=1e-9)
    assert sum(dealt) < 600 * 2 * 24
