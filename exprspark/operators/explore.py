"""Sample-level and group-level summaries: correlation, PCA, shares, spreads, histograms, Venn counts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.functions.stats import t_quantile_col
from exprspark.operators.ranking import exact_quantiles, ordered_index
from exprspark.session import spread, spread_width, stage

EXTRA = 10  # directions iterated besides the wanted components
RESIDUAL = 1e-7  # largest residual of a settled component, as a share of the first eigenvalue
WIDTH, DIRECTIONS = 64, 1 << 20  # directions iterated at once, where as many numbers hold them; else the wanted components and EXTRA
KEPT, HELD = 12, 1 << 24  # times as many directions are kept before they are cut back, where as many numbers hold them; else 4 times
SIDE, BLOCK, PART = 256, 1 << 22, 1 << 13  # samples of a tile of directions; entries of a block of features; numbers of a matrix in a row


PAIRS = 1 << 22  # products of a task that are summed up together before they leave it
TILE, PIECE, ROWS = 1024, 1024, 1 << 16  # most samples of a tile; products in a row that is sent; pairs in a batch that is returned
PAIR_PART = 1 << 25  # pairs of samples that a partition returns


def _numbered(values: DataFrame) -> DataFrame:
    ids = ordered_index(values.select("sample_id").filter("sample_id IS NOT NULL").distinct(), [F.col("sample_id")], out="idx")
    return stage(ids.withColumn("idx", (F.col("idx") - 1).cast("int")))


def _tile_of(n_samples: int) -> int:
    return min(TILE, max(TILE // 4, -(-n_samples // 8)))


def _products(values: DataFrame, value: str, ids: DataFrame, n_samples: int, tile: int, block: int) -> DataFrame:
    """``ti, tj, at, dot``: parts of the dot products of the samples of two tiles, ``at`` is the place in the tile.

    A feature that is present in many samples is copied to all tiles, and a task multiplies two ``block x tile`` pieces. One that is present
    in so few that its own pairs are fewer than those copies gives its pairs instead, summed up by task. So a sparse matrix costs its
    pairs, and a dense one its copies.
    """
    n_tiles = max(1, -(-n_samples // tile))
    rows = stage(values.join(ids.select("sample_id", "idx"), "sample_id").groupBy("feature_id").agg(
        F.collect_list(F.struct("idx", F.col(value).cast("double").alias("x"))).alias("c")))
    many = F.size("c") > 4 * n_tiles  # a copied entry takes more bytes than a product
    n_blocks = max(1, -(-rows.filter(many).count() // block))
    t = F.floor(F.col("idx") / tile).cast("int")
    x = rows.filter(many).select("feature_id", F.inline("c")).select(
        F.pmod(F.xxhash64("feature_id"), F.lit(n_blocks)).alias("block"), "feature_id", "idx", "x", t.alias("t"),
        F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))).alias("o"),
    ).select("block", "feature_id", "idx", "x", F.least("t", "o").alias("ti"), F.greatest("t", "o").alias("tj"))
    names = ["ti", "tj", "at", "dot"]

    def pieces(ti: np.ndarray, tj: np.ndarray, at: np.ndarray, dot: np.ndarray) -> pa.RecordBatch:
        """Rows of bounded size for products that are sorted by tiles."""
        first = np.flatnonzero(np.r_[True, (ti[1:] != ti[:-1]) | (tj[1:] != tj[:-1])][:len(at)])
        sizes = np.diff(np.r_[first, len(at)])
        nth = np.arange(len(at)) - np.repeat(first, sizes)
        begin = np.flatnonzero(nth % PIECE == 0)
        ends = pa.array(np.r_[begin, len(at)].astype(np.int32))
        return pa.record_batch([
            pa.array(ti[begin].astype(np.int32)), pa.array(tj[begin].astype(np.int32)),
            pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(dot))], names)

    def product(key: tuple, part: pa.Table) -> pa.Table:
        ti, tj = (k.as_py() for k in key[1:])
        row, _ = pd.factorize(part.column("feature_id").to_pandas(), use_na_sentinel=False)
        idx, v, n = part.column("idx").to_numpy(), part.column("x").to_numpy(), row.max() + 1
        # a diagonal tile meets itself
        side = [(row[m], idx[m] - at * tile, v[m]) for at in (ti, tj) for m in [idx // tile == at]]
        count = [np.bincount(r, minlength=n) for r, _, _ in side]
        if (count[0] * count[1]).sum() * 16 > n * tile * tile or not np.isfinite(v).all():
            dense = [np.zeros((n, tile)), np.zeros((n, tile))]
            for d, (r, i, y) in zip(dense, side):
                d[r, i] = y
            dot = (dense[0].T @ dense[1]).ravel()
        else:
            dot = np.zeros(tile * tile)
            (r, i, y), (q, j, z) = ([c[o] for c in s] for s in side for o in [np.argsort(s[0], kind="stable")])
            begin, each = (np.cumsum(count[1]) - count[1])[r], count[1][r]
            step = np.r_[np.flatnonzero(np.diff(np.cumsum(each) // PAIRS)) + 1, len(r)]
            for lo, hi in zip(np.r_[0, step[:-1]], step):
                e = each[lo:hi]
                left = np.repeat(np.arange(lo, hi), e)
                right = np.repeat(begin[lo:hi] - np.cumsum(e) + e, e) + np.arange(e.sum())
                dot += np.bincount(i[left] * tile + j[right], y[left] * z[right], tile * tile)
        at = np.flatnonzero(dot)
        if ti == tj:
            at = at[at // tile <= at % tile]
        return pa.Table.from_batches([pieces(np.full(len(at), ti), np.full(len(at), tj), at, dot[at])])

    def summed(parts: list) -> pa.RecordBatch:
        pair, dot = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        tiles, at = np.divmod(pair[first], tile * tile)
        return pieces(tiles // n_tiles, tiles % n_tiles, at, np.add.reduceat(dot[order], first))

    def pairs(batches):
        held, size = [], 0
        for b in batches:
            idx, x, n = (b.column(c) for c in ("idx", "x", "n"))
            idx, x, n = idx.flatten().to_numpy().astype(np.int64), x.flatten().to_numpy(zero_copy_only=False), n.to_numpy()
            begin = np.cumsum(n) - n
            for m in np.unique(n):
                left, right = np.triu_indices(m)
                at = begin[n == m]
                step = max(1, PAIRS // len(left))
                for k in range(0, len(at), step):
                    some = at[k:k + step, None]
                    p, q = idx[some + left], idx[some + right]
                    p, q = np.minimum(p, q).ravel(), np.maximum(p, q).ravel()
                    held.append((((p // tile * n_tiles + q // tile) * tile + p % tile) * tile + q % tile, (x[some + left] * x[some + right]).ravel()))
                    size += len(p)
                    if size >= PAIRS:
                        yield summed(held)
                        held, size = [], 0
        if held:
            yield summed(held)

    schema = "ti int, tj int, at array<int>, dot array<double>"
    x = spread(x, "block", "ti", "tj", groups=n_blocks * n_tiles * (n_tiles + 1) // 2)
    dense = x.groupBy("block", "ti", "tj").applyInArrow(product, schema)
    sparse = rows.filter(~many).select(F.col("c.idx").alias("idx"), F.col("c.x").alias("x"), F.size("c").alias("n")).mapInArrow(pairs, schema)
    return dense.unionByName(sparse)


def _all_pairs(products: DataFrame, sides: DataFrame, n_samples: int, tile: int, made, schema: str, first: int) -> DataFrame:
    """``made(left, right, i, j, dot)`` for all pairs of samples from ``j - i >= first`` on, whether they share a feature or not.

    ``sides`` is ``idx`` and what ``made`` needs of a sample. The products of two tiles are added up where their pairs are
    returned: pairs are never shuffled, and a task holds one tile.
    """
    spark = products.sparkSession
    n_tiles = max(1, -(-n_samples // tile))
    fields = [c for c in sides.columns if c != "idx"]
    held = stage(sides.withColumn("tile", F.floor(F.col("idx") / tile).cast("int")).groupBy("tile").agg(
        F.array_sort(F.collect_list(F.struct("idx", *fields))).alias("side")))
    last = F.lit(n_tiles - 1)
    left = held.select(F.col("tile").alias("ti"), F.explode(F.sequence("tile", last)).alias("tj"), F.lit(0).alias("kind"), "side")
    right = held.select(F.explode(F.sequence(F.lit(0), "tile")).alias("ti"), F.col("tile").alias("tj"), F.lit(1).alias("kind"), "side")
    rows = left.unionByName(right).unionByName(products.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    n = max(spread_width(spark), n_samples * n_samples // 2 // PAIR_PART)
    # sorted, so that a task reads one tile after the other
    rows = rows.repartition(min(n, n_tiles * (n_tiles + 1) // 2), "ti", "tj").sortWithinPartitions("ti", "tj", "kind")

    def returned(ti: int, tj: int, side: list, dot: np.ndarray):
        a, b = (s.field("idx").to_numpy() for s in side)
        dot = dot.reshape(tile, tile)
        step = max(1, ROWS // len(b))
        for lo in range(0, len(a), step):
            some = np.arange(lo, min(lo + step, len(a)))
            i, j = np.nonzero(b - a[some, None] >= first) if ti == tj else np.indices((len(some), len(b))).reshape(2, -1)
            if len(i):
                yield made(side[0], side[1], i + lo, j, dot[i + lo, j])

    def run(batches):
        now, side, dot = None, [], np.zeros(0)
        for b in batches:
            ti, tj, kind = (b.column(c).to_numpy() for c in ("ti", "tj", "kind"))
            cuts = np.flatnonzero(np.r_[True, (ti[1:] != ti[:-1]) | (tj[1:] != tj[:-1]) | (kind[1:] != kind[:-1])][:len(ti)])
            for lo, hi in zip(cuts, [*cuts[1:], len(ti)]):
                if now != (ti[lo], tj[lo]):
                    if now:
                        yield from returned(*now, side, dot)
                    now, side, dot = (ti[lo], tj[lo]), [], np.zeros(tile * tile)
                if kind[lo] < 2:
                    side.append(b.column("side").slice(lo, 1).flatten())
                else:
                    np.add.at(dot, b.column("at").slice(lo, hi - lo).flatten().to_numpy(), b.column("dot").slice(lo, hi - lo).flatten().to_numpy())
        if now:
            yield from returned(*now, side, dot)

    return rows.mapInArrow(run, schema)


def sample_gram(values: DataFrame, value: str, tile: int | None = None, block: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Dot products of all sample pairs ``(i <= j)`` over features, 0 where they share none. Returns ``i, j, dot`` and the sample index table."""
    ids = _numbered(values)
    n_samples = ids.count()
    tile = tile or _tile_of(n_samples)

    def made(left, right, i, j, dot):
        i, j = (s.field("idx").to_numpy()[k] for s, k in ((left, i), (right, j)))
        return pa.record_batch([pa.array(i), pa.array(j), pa.array(dot)], ["i", "j", "dot"])

    products = _products(values, value, ids, n_samples, tile, block)
    return _all_pairs(products, ids.select("idx"), n_samples, tile, made, "i int, j int, dot double", 0), ids


def sample_correlation(
    values: DataFrame, value: str, n_features: int | Column, zero: Column | float = 0.0, tile: int | None = None, block: int = 4096
) -> DataFrame:
    """Pearson correlation of all sample pairs over ``n_features``; absent pairs have the value ``zero``.

    The correlation does not change when ``zero`` is subtracted, and the shifted matrix is sparse. Pairs that share no feature have one, too.
    """
    zero = F.lit(zero) if isinstance(zero, (int, float)) else zero
    n = F.lit(n_features) if isinstance(n_features, int) else n_features
    shifted = stage(values.select("feature_id", "sample_id", (F.col(value) - zero).alias("x")))
    ids = _numbered(shifted)
    n_samples = ids.count()
    tile = tile or _tile_of(n_samples)
    sums = shifted.groupBy("sample_id").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")).withColumn("n", n.cast("double"))
    sides = sums.join(ids, "sample_id").select("idx", "sample_id", F.col("s").cast("double").alias("s"), (F.col("n") * F.col("q") - F.col("s") * F.col("s")).alias("v"), "n")

    def made(left, right, i, j, dot):
        (s1, v1, n), (s2, v2, _) = ([side.field(c).to_numpy(zero_copy_only=False)[k] for c in ("s", "v", "n")] for side, k in ((left, i), (right, j)))
        with np.errstate(all="ignore"):
            den = np.sqrt(v1 * v2)
            found = (n * dot - s1 * s2) / den
        none = [side.field("s").is_null().to_numpy(zero_copy_only=False)[k] for side, k in ((left, i), (right, j))]
        names = [side.field("sample_id").take(pa.array(k)) for side, k in ((left, i), (right, j))]
        return pa.record_batch([*names, pa.array(found, mask=(den == 0) | np.isnan(dot) | none[0] | none[1])], ["sample_1", "sample_2", "correlation"])

    products = _products(shifted, "x", ids, n_samples, tile, block)
    return _all_pairs(products, sides, n_samples, tile, made, "sample_1 string, sample_2 string, correlation double", 1)


def pca_samples(
    values: DataFrame, value: str, k: int, n_features: int, zero: Column | float = 0.0, scale: str = "sample"
) -> tuple[DataFrame, DataFrame]:
    """Principal components of samples: ``(sample_id, pc, score)`` and ``(pc, sdev, proportion, cumulative)``.

    ``scale="sample"`` standardizes each sample over the features, ``scale="feature"`` each feature
    over the samples; then features are centred. The first ``k`` components come from :func:`_leading_components`, each
    with a residual of at most ``RESIDUAL``, for any number of samples.
    """
    spark = values.sparkSession
    zero = F.lit(zero) if isinstance(zero, (int, float)) else zero
    x = stage(values.select("feature_id", "sample_id", (F.col(value) - zero).alias("x")))
    n = x.select("sample_id").distinct().count()
    if n == 0:
        return (
            spark.createDataFrame([], "sample_id string, pc int, score double"),
            spark.createDataFrame([], "pc int, sdev double, proportion double, cumulative double"),
        )
    samples = x.select("sample_id").distinct()
    if scale == "feature":
        m = x.groupBy("feature_id").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"))
        sd = m.select("feature_id", F.sqrt((F.col("ss") - F.col("s") * F.col("s") / n) / (n - 1)).alias("sd")).filter("sd > 1e-12")
        x = x.join(sd, "feature_id").select("feature_id", "sample_id", (F.col("x") / F.col("sd")).alias("x"))
    return _leading_components(x, samples, k, n, n_features if scale == "sample" else None)


def _leading_components(x: DataFrame, samples: DataFrame, k: int, n: int, n_features: int | None) -> tuple[DataFrame, DataFrame]:
    """The first ``k`` components of ``n`` samples, by subspace iteration over the long matrix.

    Samples are numbered, and directions are a table of tiles of samples. A product with the sample-by-sample matrix sends the
    directions to every block of features, which returns its part of the product: one exchange there and one back; the blocks
    stay where they are. The directions grow by the residuals of the best ones and are cut back to the better half when they are many:
    the more are kept, the fewer rounds are needed where eigenvalues lie close. Only matrices of directions by directions reach the
    driver. With ``n_features`` samples are standardized first.
    """
    spark = x.sparkSession
    width = min(n, max(k + EXTRA, min(WIDTH, DIRECTIONS // n)))
    most = max(4 * width, min(KEPT * width, HELD // n))
    if n_features is None:
        ids = samples.select("sample_id", F.lit(0.0).alias("a"), F.lit(0.0).alias("m"))
    else:
        sums = x.groupBy("sample_id").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"))
        sd = stage(sums.select("sample_id", "s", F.sqrt((F.col("ss") - F.col("s") * F.col("s") / n_features) / (n_features - 1)).alias("sd")))
        constant = sd.filter("NOT coalesce(sd, 0) > 0 OR isnan(sd)").count()
        if constant:
            raise ValueError(f"{constant} samples have the same value in all features and cannot be standardized")
        x = x.join(sd, "sample_id").select("feature_id", "sample_id", (F.col("x") / F.col("sd")).alias("x"))
        ids = sd.select("sample_id", (F.col("s") / F.col("sd")).alias("a"), (F.col("s") / F.col("sd") / n_features).alias("m"))
    x = stage(x)
    ids = ordered_index(ids.filter("sample_id IS NOT NULL"), [F.col("sample_id")], out="idx")
    ids = stage(ids.withColumn("idx", (F.col("idx") - 1).cast("int")))
    rows = ids.count()
    n_tiles = max(1, -(-rows // SIDE))
    cores = spark.sparkContext.defaultParallelism
    n_blocks = cores * max(1, -(-x.count() // (BLOCK * cores)))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        f, _ = pd.factorize(pdf["feature_id"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "f": [f.astype(np.int32)], "i": [pdf["idx"].to_numpy()], "x": [pdf["x"].to_numpy()]})

    block = F.pmod(F.xxhash64("feature_id"), F.lit(n_blocks)).cast("int").alias("block")
    entries = x.filter("feature_id IS NOT NULL AND x IS NOT NULL").join(ids.select("sample_id", "idx"), "sample_id").select(block, "feature_id", "idx", "x")
    held = stage(spread(entries, "block", groups=n_blocks).groupBy("block").applyInPandas(packed, "block int, f array<int>, i array<int>, x array<double>"))
    held = spread(held, "block", groups=n_blocks).sortWithinPartitions("block").persist()
    held.count()  # from here on its partitions are known, and no product moves them

    def listed(parts: list) -> pa.Array:
        ends = np.cumsum([0, *(p.size for p in parts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.ravel(p) for p in parts]) if parts else np.zeros(0)))

    def tiled(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1].to_numpy(), "a": [pdf["a"].to_numpy()], "m": [pdf["m"].to_numpy()]})

    sides = ids.select((F.col("idx") / SIDE).cast("int").alias("tile"), "idx", "a", "m").groupBy("tile").applyInPandas(
        tiled, "tile int, a array<double>, m array<double>")

    def product(z: DataFrame, size: int) -> DataFrame:
        """``tile, v``: the matrix times its transpose times the directions ``q`` of ``z``."""

        def part(left: pa.Table, right: pa.Table) -> pa.Table:
            names = ["tile", "at", "v"]
            if left.num_rows == 0 or right.num_rows == 0:
                return pa.table([pa.array([], pa.int32()), pa.array([], pa.list_(pa.int32())), pa.array([], pa.list_(pa.float64()))], names)
            f, i, v = (left.column(c)[0].values.to_numpy() for c in ("f", "i", "x"))
            q = np.zeros((size, rows))
            for t, one in zip(right.column("tile").to_pylist(), right.column("q")):
                one = one.values.to_numpy().reshape(-1, size)
                q[:, t * SIDE:t * SIDE + len(one)] = one.T
            met, i = np.unique(i, return_inverse=True)
            out = np.empty((len(met), size))
            for j in range(size):
                out[:, j] = np.bincount(i, v * np.bincount(f, v * q[j, met][i])[f])
            cuts = np.flatnonzero(np.diff(met // SIDE)) + 1
            at = np.split((met % SIDE).astype(np.int32), cuts)
            ends = pa.array(np.cumsum([0, *(len(p) for p in at)]).astype(np.int32))
            tiles = pa.array((met // SIDE).astype(np.int32)[np.r_[0, cuts]])
            return pa.table([tiles, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(at))), listed(np.split(out, cuts))], names)

        def added(key: tuple, parts: pa.Table) -> pa.Table:
            total = np.zeros((min(SIDE, rows - key[0].as_py() * SIDE), size))
            for at, v in zip(parts.column("at"), parts.column("v")):
                total[at.values.to_numpy()] += v.values.to_numpy().reshape(-1, size)
            return pa.table([pa.array([key[0].as_py()], pa.int32()), listed([total])], ["tile", "v"])

        dealt = spread(z.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), "tile", "q"), "block", groups=n_blocks)
        parts = held.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(part, "tile int, at array<int>, v array<double>")
        return spread(parts, "tile", groups=n_tiles).groupBy("tile").applyInArrow(added, "tile int, v array<double>")

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        drawn = [np.random.default_rng([1, t]).uniform(-1, 1, (len(a), width)).ravel() for t, a in zip(pdf["tile"], pdf["a"])]
        return pdf.assign(q=drawn)

    first = stage(product(sides.select("tile", F.transform("a", lambda _: F.lit(1.0)).alias("q")), 1))
    sides = stage(sides.join(first, "tile", "left").select("tile", "a", "m", F.coalesce("v", F.transform("a", lambda _: F.lit(0.0))).alias("s")))
    sum_a, sum_m = ids.agg(F.coalesce(F.sum("a"), F.lit(0.0)), F.coalesce(F.sum("m"), F.lit(0.0))).first()
    sum_s = sides.agg(F.coalesce(F.sum(F.aggregate("s", F.lit(0.0), lambda t, y: t + y)), F.lit(0.0))).first()[0]

    def shape(b: pa.RecordBatch, c: str, size: int) -> list:
        return [np.reshape(v.values.to_numpy(), (-1, size)) if v.is_valid else None for v in b.column(c)]

    def collected(df: DataFrame, run, across: int, down: int) -> np.ndarray:
        """Matrices of the same shape, summed per task first."""

        def total(batches):
            out = np.zeros((across, down))
            for b in batches:
                out += run(b)
            cut = np.split(out.ravel(), range(PART, out.size, PART))
            yield pa.record_batch([pa.array(np.arange(len(cut), dtype=np.int32)), listed(cut)], ["at", "v"])

        def added(key: tuple, parts: pa.Table) -> pa.Table:
            return pa.table([pa.array([key[0].as_py()], pa.int32()), listed([sum(v.values.to_numpy() for v in parts.column("v"))])], ["at", "v"])

        found = df.mapInArrow(total, "at int, v array<double>").groupBy("at").applyInArrow(added, "at int, v array<double>").toArrow()
        out = np.zeros(across * down)
        for at, v in zip(found.column("at").to_pylist(), found.column("v")):
            out[at * PART:at * PART + len(v)] = v.values.to_numpy()
        return out.reshape(across, down)

    def against_sides(z: DataFrame, size: int) -> np.ndarray:
        """Sums of the directions ``q``, plain and weighted by ``m`` and ``s``."""

        def run(b):
            out = np.zeros((3, size))
            for q, m, s in zip(shape(b, "q", size), b.column("m"), b.column("s")):
                out += np.stack([np.ones(len(q)), m.values.to_numpy(), s.values.to_numpy()]) @ q
            return out

        return collected(z.join(sides, "tile").select("q", "m", "s"), run, 3, size)

    def times(z: DataFrame, size: int) -> DataFrame:
        """(tile, q, u): the directions, centred, and their centred products ``u`` with the matrix of all samples.

        What rounding leaves of a mean in a small residual grows when that is scaled, so it is taken out here.
        """
        plain, c, s = against_sides(z, size)
        off = plain / max(rows, 1)
        c, s = c - sum_m * off, s - sum_s * off
        mean = (s - sum_a * c) / max(rows, 1)

        def centred(batches):
            for b in batches:
                out = []
                for v, a, s in zip(shape(b, "v", size), shape(b, "a", 1), shape(b, "s", 1)):
                    out.append((np.zeros((len(a), size)) if v is None else v - s * off) - a * c - mean)
                yield pa.record_batch([b.column("tile"), listed([q - off for q in shape(b, "q", size)]), listed(out)], ["tile", "q", "u"])

        whole = z.select("tile", "q").join(sides.select("tile", "a", "s"), "tile").join(product(z, size), "tile", "left")
        return whole.mapInArrow(centred, "tile int, q array<double>, u array<double>")

    def products(basis: DataFrame, size: int, more: int) -> np.ndarray:
        """Dot products of the last ``more`` columns of ``q`` and of ``u`` with all columns of both."""

        def run(b):
            z = np.concatenate([np.zeros((0, 2 * size)), *(np.hstack(p) for p in zip(shape(b, "q", size), shape(b, "u", size)))])
            return np.hstack([z[:, size - more:size], z[:, 2 * size - more:]]).T @ z

        return collected(basis.select("q", "u"), run, 2 * more, 2 * size)

    def grown(dots: np.ndarray, basis: DataFrame, size: int, more: int) -> np.ndarray:
        """``dots`` of the columns before the last ``more``, and those of the last ones."""
        new = products(basis, size, more)
        old, last = (np.r_[a:b, size + a:size + b] for a, b in ((0, size - more), (size - more, size)))
        out = np.empty((2 * size, 2 * size))
        out[np.ix_(old, old)] = dots
        out[last], out[:, last] = new, new.T
        return out

    def turned(basis: DataFrame, size: int, keep: np.ndarray) -> DataFrame:
        """The directions ``keep``."""

        def run(batches):
            for b in batches:
                yield pa.record_batch([b.column("tile"), *[listed([y @ keep for y in shape(b, c, size)]) for c in ("q", "u")]], ["tile", "q", "u"])

        return basis.mapInArrow(run, "tile int, q array<double>, u array<double>")

    def residuals(basis: DataFrame, size: int, best: np.ndarray, values: np.ndarray) -> DataFrame:
        """The residuals of the directions ``best`` as new directions ``q``."""

        def run(batches):
            for b in batches:
                yield pa.record_batch([b.column("tile"), listed([u @ best - (q @ best) * values for q, u in zip(shape(b, "q", size), shape(b, "u", size))])], ["tile", "q"])

        return stage(basis.mapInArrow(run, "tile int, q array<double>"))

    def joined(both: DataFrame, new: DataFrame, size: int, more: int) -> DataFrame:
        def run(batches):
            for b in batches:
                yield pa.record_batch([b.column("tile"), *[
                    listed([np.hstack(p) for p in zip(shape(b, c, size), shape(b, f"{c}2", more))]) for c in ("q", "u")]], ["tile", "q", "u"])

        new = new.select("tile", F.col("q").alias("q2"), F.col("u").alias("u2"))
        return both.select("tile", "q", "u").join(new, "tile").mapInArrow(run, "tile int, q array<double>, u array<double>")

    drawn = stage(sides.mapInPandas(lambda pdfs: (start(p)[["tile", "q"]] for p in pdfs), "tile int, q array<double>"))
    basis, size = stage(times(drawn, width)), width
    dots = grown(np.zeros((0, 0)), basis, size, size)
    while True:
        same, cross, square = dots[:size, :size], dots[:size, size:], dots[size:, size:]
        norm = np.sqrt(np.maximum(np.diag(same), 1e-300))
        w, v = np.linalg.eigh(same / np.outer(norm, norm))
        white = (v / np.sqrt(np.maximum(w, 1e-300)))[:, w > 1e-10 * w.max()] / norm[:, None]
        small = white.T @ cross @ white
        values, v = np.linalg.eigh((small + small.T) / 2)
        values, found = values[::-1], (white @ v)[:, ::-1]
        best, top = found[:, :width], values[:width]
        rest = np.einsum("ij,ij->j", best, square @ best) - 2 * top * np.einsum("ij,ij->j", best, cross @ best) + top**2
        rest = np.sqrt(np.maximum(rest, 0)) / max(values[0], 1e-300)
        if (rest[:k] <= RESIDUAL).all() or found.shape[1] >= n - 1:
            break
        open_ = rest > RESIDUAL
        more = int(open_.sum())
        new = times(residuals(basis, size, best[:, open_] / (rest[open_] * values[0]), top[open_]), more)
        if size + more > most or found.shape[1] < size:
            keep = found if found.shape[1] + more <= most else found[:, :most // 2]
            basis, size, dots = turned(basis, size, keep), keep.shape[1], np.zeros((0, 0))
        basis, size = stage(joined(basis, new, size, more)), size + more
        dots = grown(dots, basis, size, more if dots.size else size)

    count = min(k, found.shape[1])
    values, found = np.maximum(values[:count], 0), found[:, :count]

    def by_sample(batches):
        for b in batches:
            for t, q in zip(b.column("tile").to_pylist(), shape(b, "q", count)):
                yield pa.record_batch([pa.array(np.arange(t * SIDE, t * SIDE + len(q), dtype=np.int32)), listed(list(q))], ["idx", "q"])

    last = turned(basis, size, found * np.sqrt(values)).select("tile", "q")
    held.unpersist()
    last = stage(last.mapInArrow(by_sample, "idx int, q array<double>").join(ids.select("idx", "sample_id"), "idx").select("sample_id", "q"))
    side = last.agg(*[F.max_by(F.col("q")[j], F.abs(F.col("q")[j])) for j in range(count)]).first()
    scores = last.select("sample_id", F.explode(F.array(*[
        F.struct(F.lit(j + 1).alias("pc"), (F.col("q")[j] * F.lit(-1.0 if side[j] < 0 else 1.0)).alias("score")) for j in range(count)])).alias("_x")).select("sample_id", "_x.*")
    a, am, c = ids.agg(F.sum("a"), F.sum(F.col("a") * F.col("m")), F.sum("m")).first()
    squares = x.agg(F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0))).first()[0]
    by_feature = x.groupBy("feature_id").agg(F.sum("x").alias("t")).agg(F.coalesce(F.sum(F.col("t") * F.col("t")), F.lit(0.0))).first()[0]
    total = squares - am - (by_feature - c * a) / n
    share = values / total
    importance = [(j + 1, float(np.sqrt(values[j] / (n - 1))), float(share[j]), float(share[:j + 1].sum())) for j in range(count)]
    return scores, spark.createDataFrame(importance, "pc int, sdev double, proportion double, cumulative double")


def pca_vectors(vectors: DataFrame, k: int, id_col: str = "cell_id", vec: str = "vec") -> tuple[DataFrame, DataFrame]:
    """PCA over many rows: ``(id, scores array)`` and ``(pc, proportion)``; the covariance is summed on the executors."""
    v = vectors.select(id_col, array_to_vector(vec).alias("_v"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="_v", outputCol="_c").fit(v).transform(v)
    model = PCA(k=k, inputCol="_c", outputCol="_s").fit(centred)
    scores = model.transform(centred).select(id_col, vector_to_array("_s").alias("scores"))
    shares = [(i + 1, float(p)) for i, p in enumerate(model.explainedVariance)]
    return scores, vectors.sparkSession.createDataFrame(shares, "pc int, proportion double")


def explained_variance(scores: DataFrame) -> DataFrame:
    """Variance share of each computed component, ``stdev^2 / sum``, from ``(pc, score)`` rows."""
    v = scores.groupBy("pc").agg(F.var_samp("score").alias("variance"))
    total = v.agg(F.sum("variance")).scalar()
    return v.select("pc", F.sqrt("variance").alias("sdev"), F.try_divide(F.col("variance"), total).alias("proportion"))


def covariate_r2(scores: DataFrame, samples: DataFrame, factor: str, pc: int = 1) -> DataFrame:
    """Adjusted R2 of one component on a factor: one-way analysis of variance sums."""
    x = scores.filter(F.col("pc") == pc).join(samples, "sample_id")
    g = x.groupBy(factor).agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s"), F.sum(F.col("score") * F.col("score")).alias("q"))
    t = g.agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"), F.count(F.lit(1)).alias("k"),
    )
    total = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    within = F.col("q") - F.col("b")
    r2 = 1 - F.try_divide(within, total)
    adj = 1 - F.try_divide((1 - r2) * (F.col("n") - 1), F.col("n") - F.col("k"))
    return t.select(F.lit(factor).alias("covariate"), r2.alias("r2"), adj.alias("adj_r2"))


def class_share(deg: DataFrame, cls: str = "biotype") -> DataFrame:
    """Percent of each class among UP and among DN rows; null where a side has none."""
    up, dn = F.col("log_fc") > 0, F.col("log_fc") < 0
    t = deg.filter(F.col(cls).isNotNull())
    totals = t.agg(F.struct(F.count_if(up).alias("up"), F.count_if(dn).alias("dn"))).scalar()
    g = t.groupBy(cls).agg(F.count_if(up).alias("u"), F.count_if(dn).alias("d")).filter("u > 0 or d > 0")
    return g.withColumn("t", totals).select(
        cls, F.when(F.col("u") > 0, F.col("u") * 100.0 / F.col("t.up")).alias("freq_up"),
        F.when(F.col("d") > 0, F.col("d") * 100.0 / F.col("t.dn")).alias("freq_dn"),
    )


def deg_counts(deg: DataFrame) -> DataFrame:
    return deg.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("log_fc") > 0).alias("up"),
        F.count_if(F.col("log_fc") < 0).alias("down"),
    )


def summary_se(df: DataFrame, value: str, by: Sequence[str], conf: float = 0.95, na_rm: bool = False) -> DataFrame:
    """N, mean, sd, se and the half-width of the t interval.

    Without ``na_rm`` a group with a null value has null statistics, and N counts its nulls.
    """
    v = F.col(value)
    g = df.groupBy(*by).agg(
        (F.count(value) if na_rm else F.count(F.lit(1))).alias("n"), F.count(value).alias("_k"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"),
    )
    whole = F.lit(True) if na_rm else F.col("_k") == F.col("n")
    g = g.select(
        *by, "n", F.when(whole, F.col("mean")).alias("mean"),
        F.when(whole & (F.col("_k") > 1), F.col("sd")).alias("sd"),
    ).withColumn("se", F.col("sd") / F.sqrt("n"))
    return g.withColumn("ci", F.col("se") * t_quantile_col(conf / 2 + 0.5, (F.col("n") - 1).cast("double")))


def collapse_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(value))


def collapse_max_mean(matrix: DataFrame, groups: DataFrame, group: str = "symbol") -> DataFrame:
    """Of the features that share a symbol keep the one with the highest total (ties: smaller id)."""
    total = matrix.groupBy("feature_id").agg(F.sum("count").alias("t")).join(groups.select("feature_id", group), "feature_id")
    best = total.groupBy(group).agg(F.min(F.struct((-F.col("t")).alias("t"), F.col("feature_id"))).alias("b"))
    return matrix.join(best.select(F.col("b.feature_id").alias("feature_id"), group), "feature_id")


def first_per_group(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in an explicit order, by a pre-aggregated struct minimum."""
    rest = [c for c in df.columns if c not in key]
    ord_cols = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    g = df.groupBy(*key).agg(F.min(F.struct(*ord_cols, *rest)).alias("_f"))
    return g.select(*key, *[F.col(f"_f.{c}").alias(c) for c in rest]).select(*df.columns)


def max_abs_per_group(df: DataFrame, key: str, value: str, id_col: str) -> DataFrame:
    """The row with the largest absolute value, without ties."""
    return first_per_group(df, [key], [-F.abs(F.col(value)), F.col(id_col)])


def venn_counts(sets: DataFrame, set_col: str = "set_id", key: str = "feature_id") -> DataFrame:
    """Sizes of all regions: members by the bit mask of the sets (0, 1, 2, ...) they belong to."""
    bit = F.expr(f"shiftleft(1, {set_col})")
    return sets.groupBy(key).agg(F.bit_or(bit).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts per pair and the share of each column class within its row."""
    g = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    total = g.groupBy(row).agg(F.sum("n").alias("_t"))
    return g.join(total, row).select(row, col, "n", (F.col("n") / F.col("_t")).alias("share"))


def status_summary(status: DataFrame) -> DataFrame:
    """Counts and shares per sample and read status from ``(sample_id, status, n)`` rows."""
    g = status.groupBy("sample_id", "status").agg(F.sum("n").alias("n"))
    total = g.groupBy("sample_id").agg(F.sum("n").alias("_t"))
    return g.join(total, "sample_id").select("sample_id", "status", "n", F.try_divide("n", "_t").alias("share"))


def five_numbers(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    return exact_quantiles(df, by, value, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def numeric_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Five numbers plus the mean."""
    five = five_numbers(df, value, by)
    if not by:
        return five.withColumn("mean", df.agg(F.avg(value)).scalar())
    return five.join(df.groupBy(*by).agg(F.avg(value).alias("mean")), list(by))


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts of equal-width bins over ``[lo, hi]``; the top edge belongs to the last bin."""
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(value) - lo) / width) + 1, F.lit(bins))
    inside = df.filter(F.col(value).between(lo, hi)).withColumn("bin", b.cast("int"))
    return inside.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))


def strand_check(star: DataFrame) -> DataFrame:
    """Totals of the three strand columns and the name of the largest stranded one."""
    t = star.agg(*[F.sum(c).alias(c) for c in ("unstranded", "strand1", "strand2")])
    return t.withColumn("largest", F.when(F.col("strand1") >= F.col("strand2"), "strand1").otherwise("strand2"))


def list_coverage(ids: DataFrame, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """How many distinct ids of a list are mapped."""
    m = mapping.filter(F.col(target).isNotNull()).select(source).distinct().withColumn("_m", F.lit(1))
    j = ids.select(source).distinct().join(m, source, "left")
    return j.agg(
        F.count(F.lit(1)).alias("listed"), F.count("_m").alias("mapped"),
        (F.count(F.lit(1)) - F.count("_m")).alias("unmapped"),
    )
