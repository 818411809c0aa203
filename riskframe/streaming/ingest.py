"""Streaming load of source rows into split rows and a feature table, published together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.features import newest_rows
from riskframe.operators.split import split_bernoulli
from riskframe.sources.scan import folders
from riskframe.spec import CREDIT, TableSpec
from riskframe.streaming.sinks import batch_path, drain_batches


def stream_ingest(source: DataFrame, root: str, checkpoint: str, spec: TableSpec = CREDIT) -> None:
    """Write each batch's rows by split and its newest features per key, then publish both at once.

    The stream's own offsets replace the high-water mark. Readers see only published batches, so they never see rows
    without their features; a batch that died half-way is written again over what it left.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = split_bernoulli(batch, key=spec.key, seed=spec.seed)
        newest = newest_rows(rows.select(*spec.clean, spec.updated_at), spec.key, spec.updated_at)
        newest.write.mode("overwrite").parquet(batch_path(f"{root}/features", batch_id))
        rows.write.mode("overwrite").partitionBy("split").parquet(batch_path(f"{root}/rows", batch_id))
        batch.sparkSession.range(1).write.mode("overwrite").parquet(batch_path(f"{root}/published", batch_id))

    drain_batches(source, write, checkpoint)


def published(spark: SparkSession, root: str, part: str) -> DataFrame:
    """One part of all published batches, with ``batch``. A marker is published when its own write has ended."""
    names = [n for n in folders(spark, f"{root}/published") if "_SUCCESS" in folders(spark, f"{root}/published/{n}")]
    if not names:
        raise FileNotFoundError(f"nothing was published under {root}")
    return spark.read.option("basePath", f"{root}/{part}").parquet(*(f"{root}/{part}/{n}" for n in names))


def ingested(spark: SparkSession, root: str) -> DataFrame:
    """All split rows published so far."""
    return published(spark, root, "rows").drop("batch")


def streamed_features(spark: SparkSession, root: str, spec: TableSpec = CREDIT) -> DataFrame:
    """One row per key: its newest version over all published batches. Of equal times the later batch wins."""
    rows = published(spark, root, "features")
    first = [spec.key, spec.updated_at, "batch"]
    return newest_rows(rows.select(*first, *(c for c in rows.columns if c not in first)), spec.key, spec.updated_at).select(*spec.clean)
