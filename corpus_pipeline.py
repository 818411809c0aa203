"""From raw documents to a training mix, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import decontaminate, jaccard, mixing, quality, secrets
from riskframe.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return jaccard.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; every document stays."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by epoch, with the words that the mix takes of them."""
    return mixing.mixed_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("near duplicates", no_near_duplicates),
    ("benchmark decontamination", no_benchmark),
    ("secret scans", no_secrets),
    ("source mixing", mixed),
]

#: SQL cannot express the trees; tests/llm compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
