"""Fits, enrichment, networks and neighbours against brute force and planted signals."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from exprspark.operators import cells as cl
from exprspark.operators import de, enrich, gsea, hurdle, network, normalize


def long(spark, y):
    f, s = np.nonzero(y)
    return spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i:03d}" for i in f], "sample_id": [f"s{j}" for j in s], "count": y[f, s].astype(float)}))


def tmm_numpy(y):
    n = y.sum(axis=0)
    q = np.quantile(y / n, 0.75, axis=0)
    ref = int(np.argmin(np.round(np.abs(q - q.mean()), 12)))
    logs = []
    for j in range(y.shape[1]):
        both = (y[:, j] > 0) & (y[:, ref] > 0)
        a, b = y[both, j] / n[j], y[both, ref] / n[ref]
        m, av = np.log2(a) - np.log2(b), (np.log2(a) + np.log2(b)) / 2
        v = (n[j] - y[both, j]) / (n[j] * y[both, j]) + (n[ref] - y[both, ref]) / (n[ref] * y[both, ref])
        if np.abs(m).max() < 1e-6:
            logs.append(0.0)
            continue
        k = len(m)
        rm, ra = pd.Series(np.round(m, 10)).rank().to_numpy(), pd.Series(np.round(av, 10)).rank().to_numpy()
        lm, la = math.floor(k * 0.3), math.floor(k * 0.05)
        keep = (rm >= lm + 1) & (rm <= k - lm) & (ra >= la + 1) & (ra <= k - la)
        logs.append((m[keep] / v[keep]).sum() / (1 / v[keep]).sum())
    logs = np.array(logs)
    return 2 ** (logs - logs.mean())


def test_tmm_against_numpy_and_geometric_mean(spark):
    rng = np.random.default_rng(3)
    y = rng.poisson(rng.gamma(2, 20, (120, 1)) * np.array([1, 2, 0.5, 1.5, 1]))
    y[:10, 0] *= 20
    got = normalize.tmm_factors(long(spark, y)).orderBy("sample_id").toPandas()["norm_factor"].to_numpy()
    np.testing.assert_allclose(got, tmm_numpy(y.astype(float)), rtol=1e-6)
    assert np.log(got).mean() == pytest.approx(0, abs=1e-9)


def test_tpm_sums_to_a_million(spark):
    y = np.random.default_rng(1).poisson(5, (40, 4))
    lengths = spark.createDataFrame([(f"f{i:03d}", 100 + i) for i in range(40)], "feature_id string, length int")
    sums = normalize.tpm(long(spark, y), lengths).groupBy("sample_id").agg(F.sum("tpm").alias("t")).collect()
    assert all(r["t"] == pytest.approx(1e6) for r in sums)


def nb_ll(y, mu, phi):
    r = 1 / phi
    return sum(math.lgamma(v + r) - math.lgamma(r) - math.lgamma(v + 1) + (v * math.log(phi * m / (1 + phi * m)) if v else 0) - r * math.log1p(phi * m) for v, m in zip(y, mu))


def best_rate(y, lib, phi):
    lo, hi = -20.0, 5.0  # golden-section search of a concave likelihood
    f = lambda b: nb_ll(y, lib * math.exp(b), phi)
    for _ in range(200):
        a, c = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        lo, hi = (a, hi) if f(a) < f(c) else (lo, c)
    return (lo + hi) / 2


def test_nb_test_matches_likelihood_search_and_finds_planted_features(spark):
    rng = np.random.default_rng(11)
    lib = np.array([1.0, 1.3, 0.8, 1.1, 0.9, 1.2, 1.0, 0.7])
    rate = rng.gamma(3, 20, 60)
    mu = np.outer(rate, lib)
    mu[:5, 4:] *= 8
    phi = 0.1
    y = rng.negative_binomial(1 / phi, 1 / (1 + phi * mu))
    m = long(spark, y)
    samples = spark.createDataFrame([(f"s{j}", "ref" if j < 4 else "trt") for j in range(8)], "sample_id string, group string")
    sizes = y.sum(axis=0).astype(float)
    t = de.differential_expression(m, normalize.library_size(m), samples, "ref", "trt", dispersion=phi).toPandas().set_index("feature_id")
    for i in (0, 7, 30):
        row, v = t.loc[f"f{i:03d}"], y[i]
        b = [best_rate(v[g], sizes[g], phi) for g in (slice(0, 4), slice(4, 8))]
        b0 = best_rate(v, sizes, phi)
        full = nb_ll(v[:4], sizes[:4] * math.exp(b[0]), phi) + nb_ll(v[4:], sizes[4:] * math.exp(b[1]), phi)
        lr = 2 * (full - nb_ll(v, sizes * math.exp(b0), phi))
        assert row["log_fc"] == pytest.approx((b[1] - b[0]) / math.log(2), abs=1e-5)
        assert row["lr"] == pytest.approx(lr, abs=1e-5)
        assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(lr / 2)), rel=1e-4)
    est = de.differential_expression(m, normalize.library_size(m), samples, "ref", "trt").toPandas()
    top = set(est.sort_values("p_value").head(5)["feature_id"])
    assert top == {f"f{i:03d}" for i in range(5)}
    assert 0.03 < est["dispersion"].median() < 0.3
    assert (est["fdr"] >= est["p_value"] - 1e-12).all()


def test_hurdle_covariate_matches_two_part_likelihood(spark):
    rng = np.random.default_rng(5)
    n = 300
    grp = np.where(np.arange(n) % 2 == 0, "a", "b")
    cov = rng.normal(size=n)  # a value of its own in every cell
    on = rng.random(n) < 1 / (1 + np.exp(-(0.2 + 0.9 * (grp == "b") - 0.5 * cov)))
    x = np.where(on, np.abs(2 + 0.7 * (grp == "b") + 0.3 * cov + rng.normal(size=n) * 0.4) + 0.01, 0)
    cells = spark.createDataFrame(pd.DataFrame({"cell_id": [str(i) for i in range(n)], "group": grp, "cov": cov}))
    m = spark.createDataFrame(pd.DataFrame({"feature_id": "f", "cell_id": [str(i) for i in range(n)], "count": x}))
    got = de.hurdle_de(m, cells, "a", "b", ("cov",)).first()

    full = np.column_stack([np.ones(n), grp == "b", cov]).astype(float)
    null = full[:, [0, 2]]

    def logit(d):
        b = np.zeros(d.shape[1])
        for _ in range(100):
            mu = 1 / (1 + np.exp(-d @ b))
            b = b + np.linalg.solve((d * (mu * (1 - mu))[:, None]).T @ d, d.T @ (on - mu))
        mu = 1 / (1 + np.exp(-d @ b))
        return np.log(np.where(on, mu, 1 - mu)).sum()

    def rss(d):
        d = d[on]
        return ((x[on] - d @ np.linalg.lstsq(d, x[on], rcond=None)[0]) ** 2).sum()

    want = 2 * (logit(full) - logit(null)) + on.sum() * math.log(rss(null) / rss(full))
    assert got["df"] == 2
    assert got["statistic"] == pytest.approx(want, rel=1e-6)
    assert got["ci_low"] < got["log_fc"] < got["ci_high"] and got["log_fc"] > 0


def plain_hurdle(x, trt, covariates):
    """Both parts of one feature by textbook regressions: statistic, degrees of freedom, change and half-width of its interval."""
    on = x > 0
    full = np.column_stack([np.ones(len(x)), trt, *covariates]).astype(float)
    null = np.delete(full, 1, axis=1)

    def logit(d):
        b = np.zeros(d.shape[1])
        for _ in range(200):
            mu = 1 / (1 + np.exp(-d @ b))
            cov = np.linalg.inv((d * (mu * (1 - mu))[:, None]).T @ d)
            b = b + cov @ (d.T @ (on - mu))
        mu = 1 / (1 + np.exp(-d @ b))
        return b, np.log(np.where(on, mu, 1 - mu)).sum(), cov

    def level(d):
        d = d[on]
        c = np.linalg.lstsq(d, x[on], rcond=None)[0]
        rss = ((x[on] - d @ c) ** 2).sum()
        return c, rss, np.linalg.inv(d.T @ d) * rss / (on.sum() - d.shape[1])

    b, l1, v = logit(full)
    _, l0, _ = logit(null)
    c, r1, w = level(full)
    _, r0, _ = level(null)
    low, high = full.mean(axis=0), full.mean(axis=0)
    low[1], high[1] = 0, 1
    p = [1 / (1 + np.exp(-q @ b)) for q in (low, high)]
    m = [q @ c for q in (low, high)]
    gd = high * m[1] * p[1] * (1 - p[1]) - low * m[0] * p[0] * (1 - p[0])
    gc = high * p[1] - low * p[0]
    return 2 * (l1 - l0) + on.sum() * math.log(r0 / r1), p[1] * m[1] - p[0] * m[0], 1.959963984540054 * math.sqrt(gd @ v @ gd + gc @ w @ gc)


@pytest.mark.parametrize("block, tile", [(20_000, 1_000_000), (3, 40)])
def test_hurdle_with_detection_rate_and_proportion(spark, monkeypatch, block, tile):
    """Two covariates that differ from cell to cell, several features, also in small blocks and tiles; features that cannot be fitted."""
    monkeypatch.setattr(hurdle, "TILE", tile)
    rng = np.random.default_rng(12)
    n, genes = 240, 12
    trt = np.arange(n) % 2
    share = rng.dirichlet(np.ones(6))[np.arange(n) % 6]
    base = rng.normal(size=genes)
    on = rng.random((genes, n)) < 1 / (1 + np.exp(-(base[:, None] + 0.5 * trt - 2 * share)))
    x = np.where(on, np.abs(2 + rng.normal(size=(genes, 1)) + 0.4 * trt + share + rng.normal(size=(genes, n)) * 0.5) + 0.01, 0)
    x[10] = np.where(np.arange(n) < 2, 1.0, 0.0)  # two detecting cells: no level part
    x[11] = 1.0  # found in all cells, always the same: neither part
    f, c = np.nonzero(x)
    m = spark.createDataFrame(pd.DataFrame({"feature_id": [f"f{i:02d}" for i in f], "cell_id": [str(j) for j in c], "count": x[f, c]}))
    cells = spark.createDataFrame(pd.DataFrame({"cell_id": [str(j) for j in range(n)], "group": np.where(trt == 1, "b", "a"), "share": share}))
    scaled = hurdle.detection_rate(m, cells)
    rate = (x > 0).sum(axis=0)
    rate = (rate - rate.mean()) / rate.std(ddof=1)
    got_rate = {r["cell_id"]: r["detection"] for r in scaled.collect()}
    assert [got_rate[str(j)] for j in range(n)] == pytest.approx(rate.tolist())
    fit = hurdle.hurdle_fit(m, scaled, "a", "b", ("detection", "share"), block_features=block).toPandas().set_index("feature_id")
    for i in range(10):
        stat, change, half = plain_hurdle(x[i], trt, [rate, share])
        row = fit.loc[f"f{i:02d}"]
        assert row["df"] == 2 and row["statistic"] == pytest.approx(stat, rel=1e-6, abs=1e-7)
        assert row["log_fc"] == pytest.approx(change, rel=1e-6) and row["ci_high"] - row["log_fc"] == pytest.approx(half, rel=1e-6)
        assert row["pct_trt"] == pytest.approx((x[i] > 0)[trt == 1].mean()) and row["pct_ref"] == pytest.approx((x[i] > 0)[trt == 0].mean())
    assert fit.loc["f10", "df"] <= 1 and fit.loc["f11", "df"] == 0 and np.isnan(fit.loc["f11", "statistic"])
    tests = hurdle.hurdle_de(m, scaled, "a", "b", ("detection", "share"))
    assert tests.columns[:2] == ["feature_id", "log_fc"] and tests.filter("fdr < p_value - 1e-12").isEmpty()
    assert hurdle.hurdle_de(m.limit(0), scaled, "a", "b", ("share",)).count() == 0


def full_running_sum(score, hit):
    w = np.abs(score) * hit
    walk = np.cumsum(np.where(hit, w / w.sum(), -1 / (~hit).sum()))
    return walk.max() if walk.max() >= -walk.min() else walk.min()


def test_gsea_equals_the_full_running_sum_and_finds_the_planted_set(spark):
    rng = np.random.default_rng(2)
    n = 400
    score = np.sort(rng.normal(size=n))[::-1]
    ranked = spark.createDataFrame(pd.DataFrame({"feature_id": [f"g{i}" for i in range(n)], "score": score, "rank": np.arange(1, n + 1)}))
    sets = {"top": np.arange(0, 60, 3), "low": np.arange(340, 400, 3), "mix": rng.choice(n, 25, replace=False)}
    rows = [("c", t, f"g{i}") for t, idx in sets.items() for i in idx]
    gs = spark.createDataFrame(rows, "collection string, term_id string, feature_id string")
    got = gsea.gsea(ranked, gs, nperm=200).toPandas().set_index("term_id")
    for t, idx in sets.items():
        hit = np.isin(np.arange(n), idx)
        assert got.loc[t, "es"] == pytest.approx(full_running_sum(score, hit), abs=1e-8)
        assert -1 <= got.loc[t, "es"] <= 1
    assert got.loc["top", "nes"] > 1.5 and got.loc["low", "nes"] < -1.5
    assert got.loc["top", "p_value"] < 0.05 < got.loc["mix", "p_value"]
    mirrored = ranked.select("feature_id", (-F.col("score")).alias("score"), (n + 1 - F.col("rank")).alias("rank"))
    back = gsea.enrichment_scores(gsea.running_score(mirrored, gs)).toPandas().set_index("term_id")
    np.testing.assert_allclose(back.loc[["top", "low"], "es"], -got.loc[["top", "low"], "es"], atol=1e-8)


def test_gsea_null_counts_equal_brute_force(spark):
    """1,000 permutations by the documented order of hashes, sets drawn one by one."""
    import hashlib

    rng = np.random.default_rng(3)
    n, nperm = 60, 1000
    score = np.sort(rng.normal(size=n).round(3))[::-1]
    ranked = spark.createDataFrame(pd.DataFrame({"feature_id": [f"g{i}" for i in range(n)], "score": score, "rank": np.arange(1, n + 1)}))
    sets = {"a": rng.choice(n, 12, replace=False), "b": np.arange(12), "c": rng.choice(n, 25, replace=False), "d": np.arange(45, 60)}
    gs = spark.createDataFrame([("c", t, f"g{i}") for t, idx in sets.items() for i in idx], "collection string, term_id string, feature_id string")
    result = gsea.gsea(ranked, gs, nperm=nperm)
    got = result.toPandas().set_index("term_id")
    null = {m: [] for m in {len(x) for x in sets.values()}}
    for perm in range(1, nperm + 1):
        order = sorted(range(1, n + 1), key=lambda p: (hashlib.md5(f"1:{perm}:{p}".encode()).hexdigest()[:16], p))
        for m in null:
            null[m].append(round(full_running_sum(score, np.isin(np.arange(1, n + 1), order[:m])), 9))
    for t, idx in sets.items():
        es = got.loc[t, "es"]
        same = [x for x in null[len(idx)] if (x >= 0) == (es >= 0)]
        assert got.loc[t, "p_value"] == pytest.approx((1 + sum(abs(x) >= abs(es) for x in same)) / (1 + len(same)))
        assert got.loc[t, "nes"] == pytest.approx(es / np.mean(np.abs(same)))


def test_overlap_test_p_value(spark):
    a = spark.createDataFrame([(f"g{i}",) for i in range(30)], "feature_id string")
    b = spark.createDataFrame([(f"g{i}",) for i in range(20, 60)], "feature_id string")
    r = enrich.overlap_test(a, b, 200).first()
    table = np.array([[10, 20], [30, 140]], dtype=float)
    e = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    stat = ((np.abs(table - e) - 0.5) ** 2 / e).sum()
    assert r["statistic"] == pytest.approx(stat)
    assert r["p_value"] == pytest.approx(math.erfc(math.sqrt(stat / 2)))


def test_similarity_is_exact_and_copies_share_a_profile(spark):
    rng = np.random.default_rng(9)
    members = {f"t{i:02d}": set(rng.choice(60, rng.integers(3, 15), replace=False).tolist()) for i in range(40)}
    for i in range(20):  # a third of the terms are copies of one
        members[f"u{i:02d}"] = members["t00"]
    rows = [(t, f"g{x}") for t, m in members.items() for x in m]
    sets = spark.createDataFrame(rows, "term_id string, feature_id string")
    for limit in (0.2, 0.5):
        edges, profiles = network.term_similarity(sets, limit)
        got = {(r["term_1"], r["term_2"]): r["jaccard"] for r in edges.collect()}
        prof = {r["term_id"]: r["profile"] for r in profiles.collect()}
        assert prof["u19"] == "t00"
        reps = sorted(set(prof.values()))
        want = {}
        for i, a in enumerate(reps):
            for b in reps[i + 1 :]:
                j = len(members[a] & members[b]) / len(members[a] | members[b])
                if j >= limit - 1e-12:
                    want[a, b] = pytest.approx(j)
        assert got == want


def test_a_feature_of_half_of_all_terms_makes_few_candidates(spark):
    """Half of the terms share one feature and little else: candidates stay within a few times the result."""
    rng = np.random.default_rng(6)
    members = {f"t{i:03d}": {1000 * i + j for j in range(rng.integers(15, 40))} | ({-1} if i % 2 else set()) for i in range(300)}
    for i in range(0, 60, 2):  # some pairs that do reach the limit
        members[f"t{i + 1:03d}"] = set(list(members[f"t{i:03d}"])[3:]) | {-1}
    sets = spark.createDataFrame([(t, f"g{x}") for t, m in members.items() for x in m], "term_id string, feature_id string")
    made = []
    real = network._candidates
    network._candidates = lambda *args: made.append(real(*args)) or made[-1]
    try:
        edges, _ = network.term_similarity(sets, 0.05)
        got = {(r["term_1"], r["term_2"]): r["jaccard"] for r in edges.collect()}
    finally:
        network._candidates = real
    names = sorted(members)
    want = {(a, b): pytest.approx(len(members[a] & members[b]) / len(members[a] | members[b]))
            for i, a in enumerate(names) for b in names[i + 1:] if len(members[a] & members[b]) / len(members[a] | members[b]) >= 0.05}
    assert got == want and len(want) >= 30
    assert made[0].count() <= 5 * len(want)  # the feature alone is in 11,175 pairs


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(f"a{i:03d}", f"a{i + 1:03d}") for i in range(60)] + [("hub", f"h{i}") for i in range(80)]
    nodes = sorted({n for e in edges for n in e} | {"alone"})
    got = {r["node"]: r["component"] for r in network.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got["alone"] == "alone" and set(got.values()) == {"a000", "alone", "h0"}


def test_simplify_equals_the_greedy_walk(spark):
    rng = np.random.default_rng(4)
    p = {f"t{i:02d}": round(float(rng.random()), 2) for i in range(30)}
    pairs = [(f"t{i:02d}", f"t{j:02d}", float(rng.random())) for i in range(30) for j in range(i + 1, 30) if rng.random() < 0.2]
    near = {(a, b) for a, b, s in pairs if s > 0.5} | {(b, a) for a, b, s in pairs if s > 0.5}
    kept = []
    for t in sorted(p, key=lambda t: (p[t], t)):
        if not any((t, k) in near for k in kept):
            kept.append(t)
    got = enrich.simplify_terms(
        spark.createDataFrame(list(p.items()), "term_id string, p_value double"),
        spark.createDataFrame(pairs, "term_1 string, term_2 string, jaccard double"), 0.5)
    assert sorted(r["term_id"] for r in got.collect()) == sorted(kept)


@pytest.mark.parametrize("pivots,block", [(None, 2048), (6, 16), (20, 2048)])
def test_nearest_neighbours_are_exact(spark, pivots, block):
    rng = np.random.default_rng(6)
    ref = rng.normal(size=(200, 5))
    ref[:70] = ref[0] + rng.normal(size=(70, 5)) * 1e-3  # a third of the reference sits on one spot
    q = rng.normal(size=(60, 5))

    def frame(x, tag):
        return spark.createDataFrame([(f"{tag}{i:03d}", list(map(float, v))) for i, v in enumerate(x)], "cell_id string, vec array<double>")

    got = cl.knn(frame(q, "q"), frame(ref, "r"), 7, pivots=pivots, block=block).toPandas()
    d = np.round(np.sqrt(((q[:, None] - ref[None]) ** 2).sum(-1)), 9)
    for i in range(60):
        want = sorted((d[i, j], f"r{j:03d}") for j in range(200))[:7]
        mine = got[got["query_id"] == f"q{i:03d}"].sort_values("place")
        assert list(mine["ref_id"]) == [w[1] for w in want]
        np.testing.assert_allclose(mine["distance"], [w[0] for w in want])


def test_neighbour_products_grow_below_the_square(spark):
    rng = np.random.default_rng(1)
    counts = {}
    for n in (1000, 4000):
        x = rng.random((n, 2))
        df = spark.createDataFrame([(f"{i:05d}", v.tolist()) for i, v in enumerate(x)], "cell_id string, vec array<double>")
        pairs = spark.sparkContext.accumulator(0)
        got = cl.knn(df, df, 5, block=16, pairs=pairs).toPandas()
        d = np.round(np.sqrt(((x[:50, None] - x) ** 2).sum(-1)), 9)
        for i in range(50):
            assert sorted(got[got["query_id"] == f"{i:05d}"]["distance"]) == sorted(d[i])[:5]
        counts[n] = pairs.value
    assert counts[4000] < 10 * counts[1000] and counts[4000] < 4000**2 / 5  # the square would be 16 times


def test_neighbours_by_key(spark):
    rng = np.random.default_rng(2)
    rows = [(f"{i:03d}", "ab"[i % 2] if i < 150 else "c", rng.normal(size=3).tolist()) for i in range(160)]
    df = spark.createDataFrame(rows, "cell_id string, s string, vec array<double>")
    asked = spark.createDataFrame([("q1", "a", [0.0] * 3), ("q1", "c", [0.0] * 3), ("q2", "none", [0.0] * 3)], "cell_id string, s string, vec array<double>")
    got = {(r["query_id"], r["s"], r["place"]): r["ref_id"] for r in cl.knn(asked, df, 4, pivots=5, block=8, by="s").collect()}
    for s in "ac":
        want = sorted((round(float(np.sqrt((np.array(v) ** 2).sum())), 9), i) for i, t, v in rows if t == s)[:4]
        assert [got["q1", s, p] for p in range(1, 5)] == [i for _, i in want]
    assert len(got) == 8


def test_integration_of_four_samples_in_one_pass(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 4)) * np.array([0.02, 1, 1, 1])
    shifts = {"a": 0.0, "b": 0.8, "c": -0.7, "d": 0.5, "e": 0.9}
    rows = [(f"{s}{i:02d}", s, (v + rng.normal(size=4) * 0.03 + np.array([d, 0, 0, 0])).tolist()) for s, d in shifts.items() for i, v in enumerate(base)]
    v = spark.createDataFrame(rows, "cell_id string, sample_id string, vec array<double>")
    got = cl.integrate_samples(v, "sample_id", "a").toPandas()
    assert len(got) == 300
    mean = {s: np.stack(g["vec"].to_numpy())[:, 0].mean() for s, g in got.groupby("sample_id")}
    assert all(abs(mean[s] - mean["a"]) < 0.1 * abs(d) for s, d in shifts.items() if d)


def test_integration_removes_a_sample_shift(spark):
    rng = np.random.default_rng(8)
    # mutual neighbours assume that the sample effect is orthogonal to the differences between cells
    base = rng.normal(size=(80, 4)) * np.array([0.02, 1, 1, 1])
    moved = base + rng.normal(size=(80, 4)) * 0.05 + np.array([0.8, 0, 0, 0])
    rows = [(f"a{i}", "a", list(map(float, v))) for i, v in enumerate(base)] + [(f"b{i}", "b", list(map(float, v))) for i, v in enumerate(moved)]
    v = spark.createDataFrame(rows, "cell_id string, sample_id string, vec array<double>")
    got = cl.integrate_samples(v, "sample_id", "a").toPandas()
    assert len(got) == 160
    b = np.stack(got[got["sample_id"] == "b"].sort_values("cell_id")["vec"].to_numpy())
    a = np.stack(got[got["sample_id"] == "a"].sort_values("cell_id")["vec"].to_numpy())
    assert abs((b - a)[:, 0].mean()) < 0.1 * 0.8
