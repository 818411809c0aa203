"""Running a stream over what is available, and sinks that a repeated batch does not double."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append finished rows to parquet files until the available input is used up."""
    (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Call ``write(rows, batch_id)`` per micro-batch until the available input is used up."""
    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def batch_path(root: str, batch_id: int) -> str:
    """Folder of one batch; overwriting it makes a repeated batch harmless."""
    return f"{root}/batch={batch_id}"
