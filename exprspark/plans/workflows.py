"""End-to-end compositions of the operators, from inputs to named result tables.

Each returns a dict of DataFrames, ready for :func:`exprspark.sources.writers.write_results`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.operators import cells as cl
from exprspark.operators import clean, de, enrich, explore, gsea, intervals as iv, normalize, report
from exprspark.session import stage


def bulk_comparison(
    counts: DataFrame, samples: DataFrame, annotations: DataFrame, lengths: DataFrame, ref: str, trt: str,
    exclude: tuple[str, ...] = (), fdr_cut: float = 0.3, p_cut: float = 0.05, ntable: int = 15,
) -> dict[str, DataFrame]:
    """Counts to TPM, sample sums, top features and the annotated, filtered result table of two groups."""
    chosen = clean.subset_samples(samples, [ref, trt], exclude=exclude)
    m = stage(clean.subset_matrix(counts, chosen))
    kept = stage(normalize.expressed_filter(m, normalize.library_size(m)))
    factors = stage(normalize.tmm_factors(kept))
    tests = de.differential_expression(kept, factors, chosen, ref, trt)
    full = stage(clean.annotate(tests, annotations))
    res = clean.significant(full, fdr_cut, p_cut, ntable)
    return {
        "TPM": normalize.log2p1(normalize.tpm(counts, lengths), "tpm", "log2_tpm"),
        "sample_sums": normalize.library_size(counts, samples),
        "expression_extremes": normalize.extremes(normalize.mean_expression(counts), "mean_count", "feature_id", ntable),
        "log_cpm": normalize.log_cpm(kept, factors),
        "all_tests": full,
        "DEGs": res.orderBy(F.col("lr").desc(), "feature_id"),
        "class_share": explore.class_share(res),
        "counts": explore.deg_counts(res),
    }


def enrichment_tables(
    deg: DataFrame, gene_sets: DataFrame, terms: DataFrame, max_genes: int = 2000, p_cut: float = 0.05,
    p_adj_cut: float = 0.3, nperm: int = 1000,
) -> dict[str, DataFrame]:
    """A result table to over-representation and preranked enrichment tables of all collections."""
    listed = stage(report.capped_list(deg, max_genes, p_cut, [F.col("p_value"), F.col("feature_id")]).select("feature_id", "log_fc"))
    ora = enrich.describe_terms(enrich.ora(enrich.direction_lists(listed), gene_sets), terms)
    best = explore.max_abs_per_group(deg.select("feature_id", "log_fc"), "feature_id", "log_fc", "feature_id")
    ranked = report.ranked_list(best).filter("list = 'ALL'")
    runs = enrich.describe_terms(gsea.gsea(ranked, gene_sets, nperm), terms)
    return {
        "Enrich": ora.filter(F.col("p_adjust") < p_adj_cut).orderBy("p_value", "p_adjust", "term_id"),
        "GSEA": runs.filter(F.col("p_adjust") < p_adj_cut).orderBy(F.abs("nes").desc(), "term_id"),
    }


def label_cells(
    matrix: DataFrame, cells: DataFrame, vectors: DataFrame, reference: DataFrame, n_clusters: int, k: int = 15,
    min_feature: int = 200, max_feature: int = 10_000, max_mt: float = 17.4, min_score: float = 0.5,
) -> dict[str, DataFrame]:
    """Raw cells to QC-passed, labelled and clustered cells, class shares and cluster markers."""
    good = stage(cl.qc_filter(cl.cell_qc(matrix), min_feature, max_feature, max_mt))
    labels = stage(cl.transfer_labels(reference, vectors.join(good.select("cell_id"), "cell_id", "left_semi"), k))
    sure = labels.filter(F.col("max_score") > min_score)
    clusters = cl.cluster_cells(vectors.join(sure.select("cell_id"), "cell_id", "left_semi"), n_clusters)
    annotated = stage(cells.join(sure.select("cell_id", "predicted_id"), "cell_id").join(clusters, "cell_id"))
    names = cl.majority_label(annotated, "cluster", "predicted_id").select("cluster", F.col("predicted_id").alias("cell_type"))
    annotated = stage(annotated.join(names, "cluster"))
    values = normalize.log2p1(matrix.join(annotated.select("cell_id"), "cell_id", "left_semi"), "count", "value")
    markers = cl.find_markers(values, annotated.select("cell_id", "cluster"))
    return {
        "cells": annotated, "shares": explore.crosstab(annotated, "sample_id", "cell_type"),
        "markers": markers, "top_markers": cl.top_markers(markers),
    }


def coverage_and_frip(
    alignments: DataFrame, peaks: DataFrame, sizes: DataFrame, min_mapq: int = 20, chrom: str | None = iv.CHROMOSOMES
) -> dict[str, DataFrame]:
    """Alignments of all samples at once to quality measures, cut-site coverage, enriched windows and FRiP."""
    kept = stage(iv.filter_alignments(iv.deduplicate(alignments), min_mapq, chrom=chrom))
    cuts = iv.cutsites(kept)
    counts = stage(iv.count_overlaps(kept, peaks, by_start=True))
    return {
        "alignment_summary": iv.alignment_summary(alignments),
        "mito_percent": iv.mito_read_percent(alignments),
        "insert_sizes": iv.insert_size_metrics(iv.insert_sizes(kept)),
        "coverage": iv.coverage(cuts, ["sample_id", "chrom"]),
        "enriched": iv.call_enriched(kept, sizes),
        "peak_counts": counts.filter("status = 'assigned'"),
        "frip": iv.frip(counts),
    }
