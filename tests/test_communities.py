"""Communities by modularity: planted groups at two resolutions, every partition of a small graph, and the neighbour graph."""

import itertools

import numpy as np
import pytest

from exprspark.operators import communities as cm


def graph(spark, pairs):
    return cm.as_graph(spark.createDataFrame([(a, b, int(w)) for a, b, w in pairs], "a string, b string, w long"))


def quality(pairs, label, gamma):
    total = 2 * sum(w for _, _, w in pairs)
    inside = sum(2 * w for a, b, w in pairs if label[a] == label[b])
    weight = {}
    for a, b, w in pairs:
        weight[label[a]] = weight.get(label[a], 0) + w
        weight[label[b]] = weight.get(label[b], 0) + w
    return inside / total - gamma * sum(x * x for x in weight.values()) / total**2


def partitions(items):
    if not items:
        yield []
        return
    for rest in partitions(items[1:]):
        yield [[items[0]], *rest]
        for i in range(len(rest)):
            yield [*rest[:i], [items[0], *rest[i]], *rest[i + 1:]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_of_all_partitions_of_a_small_graph(spark, seed):
    rng = np.random.default_rng(seed)
    nodes = [f"n{i}" for i in range(8)]
    pairs = [(a, b, 8 if i // 4 == j // 4 else 1) for (i, a), (j, b) in itertools.combinations(enumerate(nodes), 2) if rng.random() < 0.8]
    pairs.append(("n1", "n1", 3))  # a loop
    best = max(quality(pairs, {x: i for i, part in enumerate(p) for x in part}, 1.0) for p in partitions(nodes))
    levels = cm.levels(graph(spark, pairs))
    label = {r["node"]: r["community"] for r in levels[-1].labels.collect()}
    assert levels[-1].modularity == pytest.approx(quality(pairs, label, 1.0)) == pytest.approx(best)
    assert cm.modularity(graph(spark, pairs), levels[-1].labels) == pytest.approx(best)


def ring_of_cliques(n, size):
    pairs = [(f"c{c:02d}_{i}", f"c{c:02d}_{j}", 1) for c in range(n) for i, j in itertools.combinations(range(size), 2)]
    return pairs + [(f"c{c:02d}_0", f"c{(c + 1) % n:02d}_1", 1) for c in range(n)]


def test_resolution_decides_between_cliques_and_runs_of_cliques(spark):
    """In a long ring a low resolution joins neighbouring cliques, a high one keeps every clique apart; modularity rises by level."""
    pairs = ring_of_cliques(24, 4)
    g = graph(spark, pairs)
    sizes = {}
    for gamma in (0.2, 2.0):
        levels = cm.levels(g, gamma)
        assert all(a.modularity < b.modularity for a, b in zip(levels, levels[1:]))
        label = {r["node"]: r["community"] for r in levels[-1].labels.collect()}
        assert levels[-1].modularity == pytest.approx(quality(pairs, label, gamma))
        assert all(len({label[f"c{c:02d}_{i}"] for i in range(4)}) == 1 for c in range(24))
        sizes[gamma] = len(set(label.values()))
    assert sizes[2.0] == 24 and sizes[0.2] <= 8


def test_clusters_of_planted_cells(spark):
    """Four groups in two pairs: two clusters at a low resolution, four at a higher one; numbers run from the largest cluster on."""
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0], [2.2, 0, 0], [30, 0, 0], [32.2, 0, 0]])
    sizes = [60, 50, 45, 40]
    rows = [(f"g{g}_{i:02d}", (centres[g] + rng.normal(size=3) * 0.6).tolist()) for g, n in enumerate(sizes) for i in range(n)]
    rows += [("copy_a", rows[0][1]), ("copy_b", rows[0][1])]
    cells = spark.createDataFrame(rows, "cell_id string, vec array<double>")
    found = {}
    for resolution in (0.02, 0.6):
        label = {r["cell_id"]: r["cluster"] for r in cm.modularity_clusters(cells, resolution, k=15).collect()}
        assert len(label) == len(rows) and label["copy_a"] == label["copy_b"] == label["g0_00"]
        count = sorted(((list(label.values()).count(c), c) for c in set(label.values())), key=lambda x: -x[0])
        assert [c for _, c in count] == [str(i) for i in range(len(count))]
        found[resolution] = label
    side = lambda cell: "0" if cell.startswith(("g0", "g1", "copy")) else "1"
    assert all(c == side(x) for x, c in found[0.02].items())
    for g in range(4):
        mine = [found[0.6][x] for x, _ in rows if x.startswith(f"g{g}")]
        assert max(mine.count(c) for c in set(mine)) >= 0.9 * len(mine)
    assert len({max(set(m), key=m.count) for m in ([found[0.6][x] for x, _ in rows if x.startswith(f"g{g}")] for g in range(4))}) == 4


def test_shared_neighbours_and_no_cells(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(40, 3))
    cells = spark.createDataFrame([(f"x{i:02d}", p.tolist()) for i, p in enumerate(points)], "cell_id string, vec array<double>")
    d = np.round(np.sqrt(((points[:, None] - points) ** 2).sum(-1)), 9)
    near = [set(np.lexsort((np.arange(40), d[i]))[:6].tolist()) | {i} for i in range(40)]
    want = {}
    for i, j in itertools.combinations(range(40), 2):
        if i in near[j] or j in near[i]:
            share = len(near[i] & near[j]) / len(near[i] | near[j])
            if share > 1 / 15:
                want[f"x{i:02d}", f"x{j:02d}"] = round(share * cm.UNIT)
    got = {(r["a"], r["b"]): r["w"] for r in cm.shared_neighbours(cells, 6).collect()}
    assert got == want
    assert cm.modularity_clusters(cells.limit(0)).count() == 0
    assert cm.levels(graph(spark, [])) == []
