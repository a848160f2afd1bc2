"""Documents to training sequences in five stages, each written and read again by its driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourvault.llm.common import stored
from hourvault.llm.decontaminate import decontaminated
from hourvault.llm.near_dedup import without_near_duplicates
from hourvault.llm.packing import packed_documents
from hourvault.llm.quality import clean_documents
from hourvault.llm.registry import query, table
from hourvault.llm.secret_scan import without_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failed lines."""
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity 0.8."""
    return without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets masked."""
    return without_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Sketches, suffix arrays, compressors and tokenizers are not expressible in SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is stored in the shared folder before the next one reads it.

    Empty tables pass through all stages; other columns of the documents are kept to the last but one stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline")(run)
