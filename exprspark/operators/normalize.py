"""Library sizes, CPM, TPM, TMM factors, log CPM and expression filters on the long count matrix.

The matrix ``(feature_id, sample_id, count)`` never holds zeros. Every mean, quantile or rank over
samples counts the missing pairs by number, so nothing is densified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.operators.ranking import exact_quantiles, value_ranks
from exprspark.session import stage


PARTS = 64  # that samples of a dense grid are dealt over


def library_size(matrix: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Sum of counts per sample; with ``samples`` the annotation columns are attached."""
    lib = matrix.groupBy("sample_id").agg(F.sum("count").alias("lib_size"))
    return lib if samples is None else samples.join(lib, "sample_id")


def mean_expression(matrix: DataFrame, n_samples: int | Column | None = None) -> DataFrame:
    """Mean count per feature over all samples, absent pairs counting as zero."""
    if n_samples is None:
        n_samples = matrix.agg(F.count_distinct("sample_id")).scalar()
    elif isinstance(n_samples, int):
        n_samples = F.lit(n_samples)
    return (
        matrix.groupBy("feature_id").agg(F.sum("count").alias("total"))
        .select("feature_id", (F.col("total") / n_samples).alias("mean_count"))
    )


def extremes(df: DataFrame, value: str, id_col: str, n: int) -> DataFrame:
    """The n highest and the n lowest rows with an ``end`` label (ties by id)."""
    top = df.orderBy(F.col(value).desc(), id_col).limit(n).withColumn("end", F.lit("top"))
    low = df.orderBy(F.col(value).asc(), id_col).limit(n).withColumn("end", F.lit("bottom"))
    return top.unionByName(low)


def effective_library(lib: DataFrame) -> Column:
    """``lib_size * norm_factor``, or the plain size where no factors are given."""
    return F.col("lib_size") * F.col("norm_factor") if "norm_factor" in lib.columns else F.col("lib_size")


def cpm(matrix: DataFrame, lib: DataFrame) -> DataFrame:
    """Counts per million of the effective library."""
    sizes = lib.select("sample_id", effective_library(lib).alias("_eff"))
    return matrix.join(sizes, "sample_id").select(
        "feature_id", "sample_id", "count", (F.lit(1e6) * F.col("count") / F.col("_eff")).alias("cpm")
    )


def tpm(matrix: DataFrame, lengths: DataFrame) -> DataFrame:
    """Transcripts per million: count / length, scaled to 1e6 per sample (the length unit cancels)."""
    rate = matrix.join(lengths.filter("length > 0"), "feature_id").select(
        "feature_id", "sample_id", (F.col("count") / F.col("length")).alias("rate")
    )
    total = rate.groupBy("sample_id").agg(F.sum("rate").alias("rate_sum"))
    return rate.join(total, "sample_id").select(
        "feature_id", "sample_id", (F.col("rate") / F.col("rate_sum") * 1e6).alias("tpm")
    )


def log2p1(df: DataFrame, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.log2(F.col(value) + 1))


def expressed_filter(
    matrix: DataFrame, lib: DataFrame, min_cpm: float = 1.0, min_samples: int = 2
) -> DataFrame:
    """Keep the rows of features with CPM above ``min_cpm`` in at least ``min_samples`` samples."""
    keep = (
        cpm(matrix, lib).filter(F.col("cpm") > min_cpm)
        .groupBy("feature_id").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_samples).select("feature_id")
    )
    return matrix.join(keep, "feature_id", "left_semi")


def upper_quartiles(matrix: DataFrame, lib: DataFrame, p: float = 0.75) -> DataFrame:
    """The p-quantile of count / library size per sample over all features, zeros included.

    Equal counts are summed up first, so a sample is a short (count, n) table.
    """
    n_features = matrix.agg(F.count_distinct("feature_id")).scalar()
    values = matrix.groupBy("sample_id", "count").agg(F.count(F.lit(1)).alias("n"))
    absent = matrix.groupBy("sample_id").agg((n_features - F.count(F.lit(1))).alias("n")).select(
        "sample_id", F.lit(0.0).alias("count"), "n").filter("n > 0")
    q = values.unionByName(absent).groupBy("sample_id").agg(F.percentile("count", p, F.col("n")).alias("q"))
    return q.join(lib, "sample_id").select("sample_id", "lib_size", (F.col("q") / F.col("lib_size")).alias("q"))


def tmm_factors(
    matrix: DataFrame, lib: DataFrame | None = None, trim_m: float = 0.3, trim_a: float = 0.05
) -> DataFrame:
    """Trimmed-mean-of-M-values factors: ``sample_id, lib_size, norm_factor``.

    The reference sample has the upper quartile nearest to the mean of all upper quartiles. A rank
    limit on M (or A) is the same as a value limit, so the trimming needs per-sample bounds only
    and the wide rows are never ranked or sorted themselves.
    """
    if lib is None:
        lib = matrix.groupBy("sample_id").agg(F.sum("count").alias("lib_size"))
    lib = stage(lib.select("sample_id", "lib_size"))
    uq = stage(upper_quartiles(matrix, lib))
    mean_q = uq.agg(F.avg("q")).scalar()
    ref = uq.withColumn("_d", F.round(F.abs(F.col("q") - mean_q), 12)).orderBy("_d", "sample_id").limit(1)
    ref_counts = (
        matrix.join(ref.select("sample_id", F.col("lib_size").alias("nr")), "sample_id")
        .select("feature_id", F.col("count").alias("r"), "nr")
    )
    y, n, r, nr = F.col("count"), F.col("lib_size"), F.col("r"), F.col("nr")
    ma = matrix.join(ref_counts, "feature_id").join(lib, "sample_id").select(
        "sample_id",
        F.round(F.log2((y / n) / (r / nr)), 10).alias("m"),
        F.round((F.log2(y / n) + F.log2(r / nr)) / 2, 10).alias("a"),
        ((n - y) / (n * y) + (nr - r) / (nr * r)).alias("v"),
    )
    ma = stage(ma.groupBy("sample_id", "m", "a").agg(
        F.sum(F.col("m") / F.col("v")).alias("mw"), F.sum(1 / F.col("v")).alias("w"),
        F.count(F.lit(1)).alias("n"),
    ))

    def bounds(value: str, trim: float) -> DataFrame:
        r = value_ranks(ma, ["sample_id"], value, weight="n")
        avg_rank = F.col("below") + (F.col("n") + 1) / 2
        cut = F.floor(F.col("total") * trim)
        inside = avg_rank.between(cut + 1, F.col("total") - cut)
        return r.groupBy("sample_id").agg(
            F.min(F.when(inside, F.col(value))).alias(f"{value}_lo"),
            F.max(F.when(inside, F.col(value))).alias(f"{value}_hi"),
        )

    limits = bounds("m", trim_m).join(bounds("a", trim_a), "sample_id")
    kept = F.col("m").between(F.col("m_lo"), F.col("m_hi")) & F.col("a").between(F.col("a_lo"), F.col("a_hi"))
    raw = ma.join(limits, "sample_id").groupBy("sample_id").agg(
        F.max(F.abs("m")).alias("max_m"),
        (F.sum(F.when(kept, F.col("mw"))) / F.sum(F.when(kept, F.col("w")))).alias("log_f"),
    )
    log_f = F.when(F.col("max_m") < 1e-6, F.lit(0.0)).otherwise(F.coalesce("log_f", F.lit(0.0)))
    factors = stage(lib.join(raw, "sample_id", "left").select(
        "sample_id", "lib_size", F.coalesce(log_f, F.lit(0.0)).alias("log_f")))
    centre = factors.agg(F.avg("log_f")).scalar()
    return factors.select("sample_id", "lib_size", F.pow(F.lit(2.0), F.col("log_f") - centre).alias("norm_factor"))


def scaling_factors(factors: DataFrame) -> DataFrame:
    """Track scaling: effective library in millions and its reciprocal (1 for a single sample)."""
    one = factors.agg(F.count(F.lit(1))).scalar() == 1
    scale = F.when(one, F.lit(1.0)).otherwise(F.col("lib_size") * F.col("norm_factor") / 1e6)
    return factors.select("sample_id", scale.alias("scaling_factor"), (1 / scale).alias("multiplier"))


def log_cpm(matrix: DataFrame, lib: DataFrame, prior: float = 2.0) -> DataFrame:
    """Normalized log2 CPM of the present pairs."""
    mean_l = lib.agg(F.avg(effective_library(lib))).scalar()
    sizes = lib.select("sample_id", effective_library(lib).alias("_eff")).withColumn(
        "_prior", F.lit(prior) * F.col("_eff") / mean_l
    )
    return matrix.join(sizes, "sample_id").select(
        "feature_id", "sample_id",
        F.log2((F.col("count") + F.col("_prior")) / (F.col("_eff") + 2 * F.col("_prior")) * 1e6).alias("log_cpm"),
    )


def log_cpm_of_zero(lib: DataFrame, prior: float = 2.0) -> Column:
    """The log CPM of an absent pair. The prior grows with the library, so it is one constant."""
    mean_l = lib.agg(F.avg(effective_library(lib))).scalar()
    share = F.lit(prior) / mean_l
    return F.log2(share / (1 + 2 * share) * 1e6)


def mean_log_cpm(matrix: DataFrame, lib: DataFrame, prior: float = 2.0) -> DataFrame:
    """Mean log CPM per feature over all samples."""
    zero = log_cpm_of_zero(lib, prior)
    n = lib.agg(F.count(F.lit(1))).scalar()
    g = log_cpm(matrix, lib, prior).groupBy("feature_id").agg(
        F.sum("log_cpm").alias("s"), F.count(F.lit(1)).alias("k")
    )
    return g.select("feature_id", ((F.col("s") + (n - F.col("k")) * zero) / n).alias("mean_log_cpm"))


def feature_spread(values: DataFrame, value: str, n_samples: Column, zero: Column) -> DataFrame:
    """Interquartile range per feature; absent pairs enter as one weighted row of value ``zero``.

    A feature has at most one row per sample, which bounds the group.
    """
    present = values.select("feature_id", F.col(value).alias("x"), F.lit(1).cast("long").alias("w"))
    absent = values.groupBy("feature_id").agg(F.count(F.lit(1)).alias("k")).select(
        "feature_id", zero.alias("x"), (n_samples - F.col("k")).alias("w")
    ).filter("w > 0")
    q = F.percentile("x", F.array(F.lit(0.25), F.lit(0.75)), F.col("w"))
    return present.unionByName(absent).groupBy("feature_id").agg(q.alias("q")).select(
        "feature_id", (F.col("q")[1] - F.col("q")[0]).alias("iqr")
    )


def variance_filter(spread: DataFrame, q: float = 0.75, digits: int = 9) -> DataFrame:
    """Features whose spread exceeds the q-quantile of all spreads."""
    spread = stage(spread.withColumn("iqr", F.round("iqr", digits)))
    cut = exact_quantiles(spread, [], "iqr", {"cut": q}).select("cut").scalar()
    return spread.filter(F.col("iqr") > cut)


def row_zscore(values: DataFrame, value: str, n_samples: int | Column, zero: Column | float = 0.0) -> DataFrame:
    """Standardize each feature over all samples: ``z`` of present pairs, ``zero_z`` of absent ones.

    The moments of the absent block enter by count, relative to the zero value.
    """
    n = F.lit(n_samples) if isinstance(n_samples, int) else n_samples
    zero = F.lit(zero) if isinstance(zero, (int, float)) else zero
    shifted = values.withColumn("_x", F.col(value) - zero)
    m = shifted.groupBy("feature_id").agg(F.sum("_x").alias("s"), F.sum(F.col("_x") * F.col("_x")).alias("ss"))
    m = m.select(
        "feature_id", (F.col("s") / n).alias("_mean"),
        F.sqrt((F.col("ss") - F.col("s") * F.col("s") / n) / (n - 1)).alias("_sd"),
    ).filter("_sd > 0")
    return shifted.join(m, "feature_id").select(
        "feature_id", "sample_id", ((F.col("_x") - F.col("_mean")) / F.col("_sd")).alias("z"),
        (-F.col("_mean") / F.col("_sd")).alias("zero_z"),
    )


def densify(values: DataFrame, value: str, samples: DataFrame, zero: Column | float = 0.0) -> DataFrame:
    """All pairs of the given features and samples, for matrices of a few chosen features.

    The grid is the result itself. Features are copied to the parts that samples are dealt over, so neither side is
    gathered in one place.
    """
    zero = F.lit(zero) if isinstance(zero, (int, float)) else zero
    copies = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part")
    chosen = values.select("feature_id").distinct().select("feature_id", copies)
    dealt = samples.select("sample_id").distinct().withColumn("_part", F.pmod(F.hash("sample_id"), F.lit(PARTS)))
    grid = dealt.join(chosen, "_part").drop("_part")
    return grid.join(values, ["feature_id", "sample_id"], "left").withColumn(value, F.coalesce(value, zero))
