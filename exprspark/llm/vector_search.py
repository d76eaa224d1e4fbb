"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Vectors are dealt to shards by a hash. A shard's graph is built in one task: every vector has a level drawn from its own
bytes, each level a graph over the vectors of that level and above, and the vectors of a level are inserted in
batches: a batch is searched for in the graph so far, from the entry that the levels above lead to, every new vector is
linked to near ones in different directions, and links back are pruned by the same rule. Graphs are kept as flat neighbour
arrays, one per level, in a table of byte parts. Queries stream through the shards; the nearest found in each are
ranked by exact distances on the original vectors and merged.

Equal vectors are one node. It carries the smallest ``k`` + 1 of their ids, which is all that ``k`` results without the query's own
row can hold, so copies neither fill a shard nor cut its graph. The number of shards grows with the root of the number of
rows, and with the rows once a shard holds ``SHARD_BYTES``; every query visits every shard.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without id, take no part;
vectors of different lengths are never compared; rows that repeat id and vector are one; an id's other vectors are not
results of its queries; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exprspark.session import stage

K = 10
#: links of a new node; slots of a node, which is pruned to LINKED links when they are full
LINKS, LINKED, SLOTS = 16, 32, 48
#: nodes kept in view while a graph is built, and searched
WIDTH_BUILD, WIDTH = 96, 400
#: components of the nodes inserted, pruned or searched for at a time, and bytes of their marks for visited nodes
BATCH, MARKS = 1 << 15, 64 << 20
#: vectors of a shard in 32-bit floats, at most about this many bytes
SHARD_BYTES = 32 << 20
PART_BYTES = 4 << 20
#: queries that one task streams through a shard
QUERIES = 200_000


def _batch(dim: int) -> int:
    return max(16, BATCH // dim)


class Graph:
    """One level: ``links`` is a flat array of SLOTS neighbours for each node, -1 where empty; nodes are 0..size-1."""

    def __init__(self, points: np.ndarray, links: np.ndarray | None = None):
        self.points, self.batch = points, _batch(points.shape[1])
        self.links = np.full((points.shape[0], SLOTS), -1, np.int32)
        self.size = 0
        if links is not None:
            self.links[:links.shape[0]] = links
            self.size = links.shape[0]

    def search(self, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``width`` nodes found from each query's entry, nearest first (-1 beyond), and squared distances."""
        n, most = queries.shape[0], max(1, MARKS // self.size)
        if n > most:
            parts = [self.search(queries[i:i + most], entry[i:i + most], width) for i in range(0, n, most)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        nodes, dist = np.full((n, width), -1, np.int32), np.full((n, width), np.inf, np.float32)
        done = np.ones((n, width), bool)
        seen = np.zeros((n, self.size), bool)
        nodes[:, 0], done[:, 0] = entry, False
        diff = self.points[entry] - queries
        dist[:, 0] = np.einsum("ij,ij->i", diff, diff)
        seen[np.arange(n), entry] = True
        active = np.arange(n)
        while active.size:
            at = np.argmin(done[active], axis=1)  # the nearest node that has not been opened
            open_ = ~done[active, at]
            active, at = active[open_], at[open_]
            if not active.size:
                break
            done[active, at] = True
            near = self.links[nodes[active, at]]
            row, slot = np.nonzero((near >= 0) & ~seen[active[:, None], near])
            node, query = near[row, slot], active[row]
            seen[query, node] = True
            diff = self.points[node] - queries[query]
            d = np.einsum("ij,ij->i", diff, diff)
            better = d < dist[query, -1]
            row, slot, node, d = row[better], slot[better], node[better], d[better]
            some = np.unique(row)  # queries whose view changes
            if not some.size:
                continue
            place = np.searchsorted(some, row)
            new_d = np.full((some.size, SLOTS), np.inf, np.float32)
            new_n = np.full((some.size, SLOTS), -1, np.int32)
            new_d[place, slot], new_n[place, slot] = d, node
            q = active[some]
            all_d = np.concatenate((dist[q], new_d), axis=1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            dist[q] = np.take_along_axis(all_d, order, 1)
            nodes[q] = np.take_along_axis(np.concatenate((nodes[q], new_n), axis=1), order, 1)
            opened = np.concatenate((done[q], new_n < 0), axis=1)
            done[q] = np.take_along_axis(opened, order, 1)
        return nodes, dist

    def choose(self, nodes: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, nearest first, up to ``most`` that are nearer to the row's own node than to one chosen before; then the nearest others."""
        n, c = nodes.shape
        x = self.points[np.maximum(nodes, 0)]
        norm = np.einsum("ijk,ijk->ij", x, x)
        between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        chosen, count = np.zeros((n, c), bool), np.zeros(n, np.int64)
        nearest = np.full((n, c), np.inf, np.float32)  # to what is chosen so far
        valid = nodes >= 0
        for i in range(c):
            take = valid[:, i] & (count < most) & (dist[:, i] < nearest[:, i])
            chosen[:, i] = take
            count += take
            rows = np.flatnonzero(take)
            nearest[rows] = np.minimum(nearest[rows], between[rows, i])
        rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(valid, rank, 1), np.take_along_axis(nodes, rank, 1), -1)

    def link_back(self, to: np.ndarray, new: np.ndarray) -> None:
        """Adds the links to[i] -> new[i]; full nodes are pruned."""
        order = np.argsort(to, kind="stable")
        to, new = to[order], new[order]
        first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
        nth = np.arange(to.size) - np.repeat(first, np.diff(np.concatenate((first, [to.size]))))
        used = (self.links[to] >= 0).sum(axis=1)
        fits = used + nth < SLOTS
        self.links[to[fits], (used + nth)[fits]] = new[fits]
        to, new = to[~fits], new[~fits]
        while to.size:  # one round prunes each full node and gives it its next few links
            full = np.unique(to)
            for at in range(0, full.size, self.batch):
                self._prune(full[at:at + self.batch])
            first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            nth = np.arange(to.size) - np.repeat(first, np.diff(np.concatenate((first, [to.size]))))
            now = nth < SLOTS - LINKED
            used = (self.links[to[now]] >= 0).sum(axis=1)
            self.links[to[now], used + nth[now]] = new[now]
            to, new = to[~now], new[~now]

    def _prune(self, nodes: np.ndarray) -> None:
        held = self.links[nodes]
        diff = self.points[np.maximum(held, 0)] - self.points[nodes][:, None, :]
        d = np.where(held >= 0, np.einsum("ijk,ijk->ij", diff, diff), np.inf)
        by = np.argsort(d, axis=1, kind="stable")
        kept = self.choose(np.take_along_axis(held, by, 1), np.take_along_axis(d, by, 1), LINKED)
        self.links[nodes] = -1
        self.links[nodes, :LINKED] = kept

    def insert(self, upto: int, entries) -> None:
        """Adds the nodes up to ``upto``; ``entries(points)`` gives each one's entry."""
        while self.size < upto:
            at, to = self.size, min(upto, self.size + min(self.batch, max(self.size, 16)))
            ids = np.arange(at, to, dtype=np.int32)
            x = self.points[at:to]
            if at:
                nodes, dist = self.search(x, entries(x), WIDTH_BUILD)
            else:
                nodes, dist = np.full((to, 0), -1, np.int32), np.zeros((to, 0), np.float32)
            norm = np.einsum("ij,ij->i", x, x)
            among = norm[:, None] + norm[None, :] - 2 * x @ x.T
            np.fill_diagonal(among, np.inf)
            few = min(LINKS, to - at - 1)
            if few:
                own = np.argpartition(among, few - 1, axis=1)[:, :few]
                nodes = np.concatenate((nodes, ids[own]), axis=1)
                dist = np.concatenate((dist, np.take_along_axis(among, own, 1)), axis=1)
            by = np.argsort(dist, axis=1, kind="stable")
            chosen = self.choose(np.take_along_axis(nodes, by, 1), np.take_along_axis(dist, by, 1), LINKS)
            self.links[at:to, :chosen.shape[1]] = chosen
            self.size = to
            row, slot = np.nonzero(chosen >= 0)
            new, old = ids[row], chosen[row, slot]
            back = ~(self.links[old] == new[:, None]).any(axis=1)
            self.link_back(old[back], new[back])


class Index:
    """Levels from the top (fewest nodes) down to all nodes; node numbers are those of the sorted nodes in every level."""

    def __init__(self, points: np.ndarray, levels: list[np.ndarray]):
        self.points = points
        self.graphs = []
        for links in levels:
            graph = Graph(points[:links.shape[0]])
            graph.links, graph.size = links, links.shape[0]
            self.graphs.append(graph)

    @staticmethod
    def build(points: np.ndarray, counts: list[int]) -> Index:
        """``counts``: how many nodes, from the first on, each level has, from the top down."""
        index = Index(points, [])
        for count in counts:
            graph = Graph(points[:count], index.graphs[-1].links if index.graphs else None)
            graph.insert(count, index.entries)
            index.graphs.append(graph)
        return index

    def entries(self, queries: np.ndarray) -> np.ndarray:
        """The node that the levels so far lead to."""
        at = np.zeros(queries.shape[0], np.int32)
        for graph in self.graphs:
            at = graph.search(queries, at, 4)[0][:, 0]
        return at

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        at = np.zeros(queries.shape[0], np.int32)
        for graph in self.graphs[:-1]:
            at = graph.search(queries, at, 4)[0][:, 0]
        return self.graphs[-1].search(queries, at, width)[0]


def _scaled(vectors: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    """For the walk through the graph only: 32-bit floats around the shard's centre."""
    return ((vectors.astype(np.float64) - centre) / scale).astype(np.float32)


def _level(vector: bytes) -> int:
    """Geometric with ratio LINKS, from the vector's own bytes."""
    u, level = (zlib.crc32(vector) + 1) / 2**32, 0
    while u * LINKS < 1:
        u, level = u * LINKS, level + 1
    return level


def _build_shard(key: tuple, table: pa.Table) -> pa.Table:
    """The index of one shard as rows (dim, shard, part, bytes)."""
    dim, shard = (x.as_py() for x in key)
    vectors = table.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
    ids = table.column("vec_id").to_numpy()
    raw = np.ascontiguousarray(vectors + 0.0).view(np.dtype((np.void, vectors.itemsize * dim))).ravel()  # -0.0 is 0.0
    _, first, node = np.unique(raw, return_index=True, return_inverse=True)
    levels = np.array([_level(raw[i].tobytes()) for i in first])
    order = np.lexsort((np.arange(first.size), -levels))  # upper levels first
    rank = np.empty(order.size, np.int64)
    rank[order] = np.arange(order.size)
    points = vectors[first[order]] + vectors.dtype.type(0)
    centre = points.mean(axis=0, dtype=np.float64)
    scale = float(np.abs(points - centre).max()) or 1.0
    counts = [int((levels >= h).sum()) for h in range(levels.max(), -1, -1)]
    index = Index.build(_scaled(points, centre, scale), counts)
    owners = np.unique(np.stack([rank[node], ids], 1), axis=0)  # sorted by node, then id
    held = {
        "points": points, "centre": centre, "scale": np.array([scale]), "owner": np.searchsorted(owners[:, 0], np.arange(first.size + 1)), "ids": np.ascontiguousarray(owners[:, 1]),
        **{f"links{i}": g.links for i, g in enumerate(index.graphs)},
    }
    blob = _packed(held)
    parts = [blob[at:at + PART_BYTES] for at in range(0, len(blob), PART_BYTES)]
    n = len(parts)
    return pa.table({"dim": pa.array([dim] * n, pa.int32()), "shard": pa.array([shard] * n, pa.int32()), "part": pa.array(range(n), pa.int32()), "bytes": pa.array(parts, pa.binary())})


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    import io

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(blob: bytes) -> dict[str, np.ndarray]:
    import io

    with np.load(io.BytesIO(blob), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


class Shard:
    """An index read back from its parts."""

    def __init__(self, blob: bytes):
        held = _unpacked(blob)
        self.points, self.centre, self.scale = held["points"], held["centre"], float(held["scale"][0])
        self.owner, self.ids = held["owner"], held["ids"]
        levels = [held[f"links{i}"] for i in range(sum(k.startswith("links") for k in held))]
        self.index = Index(_scaled(self.points, self.centre, self.scale), levels)

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id, distance) of the best ``k`` ids found for every query, its own id left out."""
        nodes = self.index.search(_scaled(queries, self.centre, self.scale), max(width, k + 1))
        row, slot = np.nonzero(nodes >= 0)
        node = nodes[row, slot]
        diff = self.points[node].astype(np.float64) - queries[row].astype(np.float64)
        dist = np.sqrt((diff * diff).sum(axis=1))
        many = self.owner[node + 1] - self.owner[node]
        at = np.repeat(self.owner[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
        row, dist, ids = np.repeat(row, many), np.repeat(dist, many), self.ids[at]
        other = ids != own[row]
        row, dist, ids = row[other], dist[other], ids[other]
        order = np.lexsort((ids, dist, row))
        row, dist, ids = row[order], dist[order], ids[order]
        first = np.searchsorted(row, row)
        kept = np.arange(row.size) - first < k
        return row[kept], ids[kept], dist[kept]


def _search_batches(k: int, width: int):
    """Reads rows sorted by (dim, shard, block, kind, part): an index's parts, then the queries for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, shard = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy() for c in ("dim", "shard", "block", "kind")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if key != tuple(keys[s, :3]):
                    key, parts, shard = tuple(keys[s, :3]), [], None
                if keys[s, 3] == 0:
                    parts += b.column("bytes").slice(s, e - s).to_pylist()
                    continue
                if shard is None and parts:
                    shard, parts = Shard(b"".join(parts)), []
                if shard is None:
                    continue
                step = _batch(int(key[0]))
                for at in range(s, e, step):
                    some = b.slice(at, min(step, e - at))
                    queries = some.column("vec").flatten().to_numpy().reshape(some.num_rows, -1)
                    own = some.column("vec_id").to_numpy()
                    row, ids, dist = shard.nearest(queries, own, k, width)
                    yield pa.record_batch([
                        pa.array(own[row]), pa.array(some.column("hash").to_numpy()[row]), pa.array(ids), pa.array(dist)], ["query_id", "hash", "vec_id", "score"])

    return run


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, dim) of the rows that take part."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size("vec"))


def build(vectors: DataFrame, k: int = K, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index table (dim, shard, part, bytes) over ``vectors`` (vec_id, vec, dim)."""
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().collect()}  # one row a vector length
    shards = {d: max(int(np.ceil(np.sqrt(n) / 64)), -(-n * d * 4 // shard_bytes)) for d, n in sizes.items()}
    if not shards:
        return vectors.sparkSession.createDataFrame([], "dim int, shard int, part int, bytes binary")
    many = F.create_map(*[F.lit(x) for d, s in shards.items() for x in (d, s)])
    # the smallest k + 1 ids of equal vectors; limited before the shuffle too, so copies never meet in one task
    same = Window.partitionBy("dim", "vec").orderBy("vec_id")
    few = vectors.withColumn("nth", F.dense_rank().over(same)).filter(F.col("nth") <= k + 1)
    shard = F.pmod(F.xxhash64("vec"), many[F.col("dim")]).cast("int")
    dealt = few.select("vec_id", "vec", "dim", shard.alias("shard"))
    return dealt.groupBy("dim", "shard").applyInArrow(_build_shard, "dim int, shard int, part int, bytes binary")


def search(vectors: DataFrame, every: int = 100, k: int = K, width: int = WIDTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose vec_id is divisible by ``every``.

    ``vectors`` has the columns vec_id (long) and vec (array of float or double).
    """
    rows = valid(vectors)
    index = stage(build(rows, k, shard_bytes))
    queries = stage(rows.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "vec", "dim", F.xxhash64("vec").alias("hash")).distinct())
    blocks = max(1, -(-queries.count() // QUERIES))
    shards = index.select("dim", "shard").distinct()
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "hash"), F.lit(blocks)).cast("int")).join(F.broadcast(shards), "dim")
    none = F.lit(None)
    kind = {f.name: f.dataType for f in vectors.schema.fields}["vec"]
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "dim", "shard", "block", F.lit(0).alias("kind"), "part", "bytes", none.cast("long").alias("vec_id"), none.cast("long").alias("hash"), none.cast(kind).alias("vec"))
    right = asked.select("dim", "shard", "block", F.lit(1).alias("kind"), F.lit(0).alias("part"), none.cast("binary").alias("bytes"), "vec_id", "hash", "vec")
    order = ["dim", "shard", "block"]
    streams = left.unionByName(right).repartition(max(1, shards.count() * blocks), *order).sortWithinPartitions(*order, "kind", "part")
    found = streams.mapInArrow(_search_batches(k, width), "query_id long, hash long, vec_id long, score double")
    best = Window.partitionBy("query_id", "hash").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
