"""Corpus preparation: documents in, token ids out. Each stage works on what the one before it kept.

Defined results: a null or empty text fails the quality rules and goes there; null languages and sources are groups of their own;
a null doc_id is kept like any other and comes last where one document of a group is chosen; rows that repeat doc_id and text are
one document from near-dedup on; very long texts pass through whole; other columns, whatever their names, stay until the last
stage; an empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from exprspark.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from exprspark.llm.catalog import bpe_path
from exprspark.llm.common import table
from exprspark.session import stage


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows go; every document stays."""
    return line_dedup.clean_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids of every document that is left."""
    return bpe.encode_documents(docs, bpe_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", apply_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: SQL has no BPE; tests hold the rows against a brute-force version of all stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
