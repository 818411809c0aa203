"""Streaming parse of the inference log and windowed quality.

Rows are stored by the hour of their log time and by batch. These stored rows are also the ledger of what was seen: a batch
is compared with the hours it holds and no others, so what it reads does not grow with the log, and no row is too late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.monitor import known_labels, monitoring_rows, quality_profile, rates
from riskframe.operators.payload import MODEL_NAME, log_second, parse_payload
from riskframe.session import stored
from riskframe.sources.scan import folders
from riskframe.sources.tables import DYNAMIC
from riskframe.spec import CREDIT, MONITOR_WINDOW, TableSpec
from riskframe.streaming.sinks import batch_path, drain_batches

COUNTS = ("rows", "tp", "fp", "fn", "tn")
LEDGER = ("request_name", "position", "hour")
NO_HOUR = "none"


def log_hour(name: str = "timestamp_ms"):
    return F.coalesce(F.date_format(log_second(F.col(name)), "yyyyMMddHH"), F.lit(NO_HOUR)).alias("hour")


def ledger_rows(spark: SparkSession, root: str, hours: Sequence[str], schema) -> DataFrame | None:
    """Stored rows of some hours with their batch; None if there are none. Other hours are not even listed."""
    there = {f"hour={h}" for h in hours} & set(folders(spark, root))
    if not there:
        return None
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(*(f"{root}/{x}" for x in sorted(there)))


def store_new(batch: DataFrame, batch_id: int, root: str, model_name: str = MODEL_NAME, spec: TableSpec = CREDIT) -> list[str]:
    """Store the batch's records that no earlier batch has, once each, and return the hours it holds.

    A record is known by request and position within its hour; a request without an id by its time and bodies.
    """
    spark = batch.sparkSession
    hours = [r[0] for r in batch.select(log_hour()).distinct().collect()]
    parsed = parse_payload(batch, model_name, spec, with_position=True, with_name=True).withColumn("hour", log_hour())
    once = parsed.dropDuplicates(list(LEDGER)).withColumn("batch", F.lit(batch_id).cast("long"))
    seen = ledger_rows(spark, root, hours, once.schema)
    if seen is not None:
        # A batch that is repeated replaces its own rows.
        keys = seen.filter(F.col("batch") != batch_id).select(*LEDGER)
        once = once.join(keys, list(LEDGER), "left_anti")
    before = spark.conf.get(DYNAMIC, None)
    spark.conf.set(DYNAMIC, "dynamic")
    try:
        # Files by hour; adaptive execution cuts large hours and joins small ones.
        once.hint("rebalance", "hour").write.mode("overwrite").partitionBy("hour", "batch").parquet(root)
    finally:
        spark.conf.set(DYNAMIC, before) if before is not None else spark.conf.unset(DYNAMIC)
    return hours


def drain_payload(log: DataFrame, root: str, checkpoint: str, model_name: str = MODEL_NAME, spec: TableSpec = CREDIT) -> None:
    """Store the parsed records of a streamed log; a repeated request is dropped and a first one kept, however late."""
    drain_batches(log, lambda batch, batch_id: store_new(batch, batch_id, root, model_name, spec) and None, checkpoint)


def parsed_records(spark: SparkSession, root: str) -> DataFrame:
    """All records stored so far."""
    return spark.read.option("basePath", root).parquet(root).drop("request_name", "hour", "batch")


def drain_quality(
    log: DataFrame, labels: Sequence[DataFrame], root: str, checkpoint: str, width: str = MONITOR_WINDOW,
    spec: TableSpec = CREDIT,
) -> None:
    """Store each batch's new records and their counts per window and model; no row is too late, no request counts twice.

    Labels are brought together once per call.
    """
    known = stored(known_labels(*labels, spec=spec).withColumnRenamed("default", spec.label), "labels")

    def write(batch: DataFrame, batch_id: int) -> None:
        hours = store_new(batch, batch_id, f"{root}/records", spec=spec)
        schema = parse_payload(batch, spec=spec, with_position=True, with_name=True).withColumn("hour", log_hour()).withColumn("batch", F.lit(0).cast("long")).schema
        rows = ledger_rows(batch.sparkSession, f"{root}/records", hours, schema)
        if rows is not None:
            own = rows.filter(F.col("batch") == batch_id)
            counts = quality_profile(monitoring_rows(own, [known], spec=spec), width)
            counts.select("window_start", "model_name", *COUNTS).write.mode("overwrite").parquet(batch_path(f"{root}/counts", batch_id))

    drain_batches(log, write, checkpoint)


def window_quality(spark: SparkSession, root: str) -> DataFrame:
    """Quality per window and model as of the last batch."""
    counts = spark.read.parquet(f"{root}/counts").groupBy("window_start", "model_name").agg(*(F.sum(c).alias(c) for c in COUNTS))
    return rates(counts)
