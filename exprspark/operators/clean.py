"""Filters, joins, set operations and reshapes over annotation, matrix and result tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.functions.scalar import strip_version

# The chromosomes of the assembled genome and the genes read off the mitochondrion.
CANONICAL_CHROMOSOMES = tuple(str(i) for i in range(1, 23)) + ("X", "Y", "MT")
MITOCHONDRIAL_GENES = (
    "MT-ND1", "MT-ND2", "MT-CO1", "MT-CO2", "MT-ATP8", "MT-ATP6", "MT-CO3",
    "MT-ND3", "MT-ND4L", "MT-ND4", "MT-ND5", "MT-ND6", "MT-CYB",
)


def drop_summary_rows(df: DataFrame, id_col: str = "gene_id") -> DataFrame:
    """Remove the ``N_*`` read-total rows of an aligner's count file."""
    return df.filter(~F.col(id_col).rlike("^N_"))


def strip_versions(matrix: DataFrame) -> DataFrame:
    """Cut version suffixes off feature ids and sum the rows that become equal."""
    return matrix.groupBy(strip_version("feature_id").alias("feature_id"), "sample_id").agg(
        F.sum("count").alias("count")
    )


def canonical_chromosomes(df: DataFrame, col: str = "chrom", allow: Sequence[str] | None = None) -> DataFrame:
    """Keep listed chromosomes, or without a list drop names with ``_`` or ``GL``."""
    if allow is not None:
        return df.filter(F.col(col).isin(list(allow)))
    return df.filter(~F.col(col).contains("_") & ~F.col(col).contains("GL"))


def clean_annotations(df: DataFrame, biotype: str | None = None) -> DataFrame:
    """Distinct rows with a symbol and a description, optionally of one biotype."""
    kept = df.filter(
        F.col("symbol").isNotNull() & (F.col("symbol") != "")
        & F.col("description").isNotNull() & (F.col("description") != "")
    )
    if biotype is not None:
        kept = kept.filter(F.col("biotype") == biotype)
    return kept.distinct()


def subset_samples(
    samples: DataFrame, groups: Sequence[str] | None = None, pattern: str | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Samples of the listed groups, or with a matching group name, minus an exclusion list."""
    out = samples
    if groups is not None:
        out = out.filter(F.col("group").isin(list(groups)))
    if pattern is not None:
        out = out.filter(F.col("group").rlike(pattern))
    if exclude:
        out = out.filter(~F.col("sample_id").isin(list(exclude)))
    return out


def subset_matrix(matrix: DataFrame, samples: DataFrame) -> DataFrame:
    return matrix.join(samples.select("sample_id"), "sample_id", "left_semi")


def significant(
    deg: DataFrame, fdr_cut: float = 0.3, p_cut: float = 0.05, ntable: int = 15
) -> DataFrame:
    """Rows below the FDR cutoff if there are more than ``ntable`` of them, else below the raw p cutoff."""
    enough = deg.agg(F.count_if(F.col("fdr") < fdr_cut)).scalar() > ntable
    return deg.filter(F.when(enough, F.col("fdr") < fdr_cut).otherwise(F.col("p_value") < p_cut))


def of_biotype(deg: DataFrame, biotype: str = "protein_coding") -> DataFrame:
    return deg.filter((F.col("biotype") == biotype) & F.col("symbol").isNotNull())


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN."""
    return df.dropna(subset=list(cols) if cols else None)


def select_matching(df: DataFrame, pattern: str, keep: Sequence[str] = (), rename: str | None = None) -> DataFrame:
    """The ``keep`` columns plus the first column whose name matches."""
    hit = next(c for c in df.columns if re.search(pattern, c))
    return df.select(*keep, F.col(f"`{hit}`").alias(rename or hit))


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.search(pattern, c)])


def relabel(df: DataFrame, mapping: DataFrame, col: str, key: str, label: str, out: str) -> DataFrame:
    """Attach the label of a mapping table; values without one stay as they are."""
    m = mapping.select(F.col(key).alias(col), F.col(label).alias("_label"))
    return df.join(m, col, "left").withColumn(out, F.coalesce("_label", col)).drop("_label")


def remove_features(matrix: DataFrame, features: DataFrame) -> DataFrame:
    return matrix.join(features.select("feature_id").distinct(), "feature_id", "left_anti")


def remove_mitochondrial(matrix: DataFrame) -> DataFrame:
    """The matrix without the listed mitochondrial genes."""
    return matrix.filter(~F.col("feature_id").isin(list(MITOCHONDRIAL_GENES)))


def features_with_prefix(matrix: DataFrame, prefix: str = "MT-") -> DataFrame:
    """Check after a removal: the features that still carry the prefix (should be none)."""
    return matrix.filter(F.col("feature_id").startswith(prefix)).select("feature_id").distinct()


def nonzero_features(matrix: DataFrame, value: str = "count") -> DataFrame:
    """Features with a total above zero."""
    return matrix.groupBy("feature_id").agg(F.sum(value).alias("total")).filter("total > 0").select("feature_id")


def negate_and_append(positive: DataFrame, negative: DataFrame, value: str) -> DataFrame:
    """Positive associations followed by the negated negative ones."""
    return positive.unionByName(negative.withColumn(value, -F.col(value)))


def correct_symbols(df: DataFrame, aliases: DataFrame, col: str = "symbol", drop_unmapped: bool = True) -> DataFrame:
    """Replace each symbol by its approved one from ``aliases(alias, approved)``."""
    a = aliases.groupBy("alias").agg(F.min("approved").alias("_approved")).withColumnRenamed("alias", col)
    out = df.join(a, col, "left").withColumn(col, F.col("_approved")).drop("_approved")
    out = out.select(*df.columns)
    return out.filter(F.col(col).isNotNull()) if drop_unmapped else out


def annotate(deg: DataFrame, annotations: DataFrame, key: str = "feature_id") -> DataFrame:
    """Left join that keeps every annotation of a key; keys without one keep a row with nulls."""
    return deg.join(annotations, key, "left").select(*deg.columns, *[c for c in annotations.columns if c != key])


def annotate_first(deg: DataFrame, annotations: DataFrame, key: str = "feature_id", order: str | None = None) -> DataFrame:
    """Left join with one annotation row per key: the first by ``order`` (default: by all columns)."""
    rest = [c for c in annotations.columns if c != key]
    order_cols = ([order] if order else []) + [c for c in rest if c != order]
    one = annotations.groupBy(key).agg(F.min(F.struct(*order_cols)).alias("_a"))
    return deg.join(one, key, "left").select(*deg.columns, *[F.col(f"_a.{c}").alias(c) for c in rest])


def with_annotations(values: DataFrame, annotations: DataFrame) -> DataFrame:
    """Inner join by feature, without duplicate rows.

    Both sides lose theirs before they meet: the joined rows are never gathered, and values that are distinct by their keys
    (as sums by group are) need no pass for it.
    """
    return values.distinct().join(annotations.distinct(), "feature_id")


def map_ids(df: DataFrame, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Attach target ids; one id may map to several, unmapped rows are dropped."""
    m = mapping.select(source, target).filter(F.col(target).isNotNull()).distinct()
    return df.join(m, source)


def unmapped(df: DataFrame, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """The distinct ids without a target."""
    m = mapping.filter(F.col(target).isNotNull()).select(source)
    return df.select(source).distinct().join(m, source, "left_anti")


def reorder_like(df: DataFrame, other: DataFrame, key: str, order: str) -> DataFrame:
    """Attach the order of another table's keys; sort by it at the sink."""
    return df.join(other.select(key, order), key)


def restrict_to(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def attach(df: DataFrame, metadata: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return df.join(metadata, key, "left")


def compare_tables(first: DataFrame, second: DataFrame, key: str, suffixes: tuple[str, str] = ("_1", "_2")) -> DataFrame:
    """Full outer join of two result tables; a null side means the key is absent there."""
    a = first.select(F.col(key), *[F.col(c).alias(c + suffixes[0]) for c in first.columns if c != key])
    b = second.select(F.col(key), *[F.col(c).alias(c + suffixes[1]) for c in second.columns if c != key])
    return a.join(b, key, "full")


def rbind(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def split_rows(df: DataFrame, col: str, sep: str, out: str | None = None) -> DataFrame:
    """One row per part of a delimited text; the parts stay text."""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(F.split(F.col(col), re.escape(sep))).alias(out or col))


def to_wide(values: DataFrame, value: str, samples: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Wide matrix for output, with an explicit list of sample columns."""
    return values.groupBy("feature_id").pivot("sample_id", list(samples)).agg(F.first(value)).fillna(fill)


def to_long(wide: DataFrame, id_cols: Sequence[str], name: str = "sample_id", value: str = "value") -> DataFrame:
    cols = [F.col(f"`{c}`") for c in wide.columns if c not in id_cols]
    return wide.unpivot([F.col(c) for c in id_cols], cols, name, value)


def ids_to_symbols(
    df: DataFrame, list_col: str, mapping: DataFrame, key: str, order: Sequence[Column] = (),
    ntop: int | None = None, keep_unmapped: bool = True, sep: str = "/", out: str = "symbols",
) -> DataFrame:
    """Translate delimited id lists to sorted symbol lists, one join for all rows.

    Each id takes its smallest symbol. With ``ntop`` only the first rows in ``order`` are
    translated and the others keep their ids.
    """
    one = mapping.filter(F.col("symbol").isNotNull()).groupBy("id").agg(F.min("symbol").alias("symbol"))
    chosen = df.orderBy(*order).limit(ntop) if ntop is not None else df
    parts = chosen.select(key, F.explode(F.split(list_col, re.escape(sep))).alias("id")).join(one, "id", "left")
    name = F.coalesce("symbol", "id") if keep_unmapped else F.col("symbol")
    texts = parts.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(name)), sep).alias("_t"))
    joined = df.join(texts, key, "left")
    if ntop is not None:
        return joined.withColumn(out, F.coalesce("_t", list_col)).drop("_t")
    return joined.withColumn(out, F.col("_t")).drop("_t")
