"""Inference logs: request and response bodies to one row per scored record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.schemas import LOG_FIELDS, PREDICTIONS, RECORDS, REQUEST_ID, request_schema, response_schema
from riskframe.spec import CREDIT, TableSpec

MODEL_NAME = "risk_model"


def parse_bodies(log: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """Log columns plus ``request_body`` and ``response_body``; a broken text gives null fields."""
    return log.select(
        *(c for c in log.columns if c in LOG_FIELDS),
        F.from_json("request", request_schema(spec)).alias("request_body"),
        F.from_json("response", response_schema()).alias("response_body"),
    )


def log_second(ms: Column) -> Column:
    """The log time as a timestamp in whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(ms))


def parse_payload(
    log: DataFrame, model_name: str = MODEL_NAME, spec: TableSpec = CREDIT, first_prediction: bool = False,
    with_position: bool = False, with_name: bool = False,
) -> DataFrame:
    """One row per request record: time, request, key, prediction, model.

    Record i gets prediction i, or null beyond the end of the list; ``first_prediction`` gives every
    record the first one. The two agree for requests with one record. ``with_name`` adds
    ``request_name``: the request id or, without one, a digest of the time and both bodies.
    """
    bodies = parse_bodies(log, spec)
    records = bodies.select(
        "*", F.posexplode(F.col(f"request_body.{RECORDS}")).alias("position", "record")
    )
    answers = F.col(f"response_body.{PREDICTIONS}")
    place = F.lit(0) if first_prediction else F.col("position")
    out = [
        log_second(F.col("timestamp_ms")).alias("timestamp"),
        F.col("timestamp_ms"),
        F.col(REQUEST_ID),
        F.col("execution_time_ms"),
        F.col(f"record.{spec.key}").alias(spec.key),
        F.get(answers, place).alias("prediction"),
        F.lit(model_name).alias("model_name"),
    ]
    unnamed = F.concat(F.lit("?"), F.md5(F.to_json(F.struct("timestamp_ms", "request", "response"))))
    if with_position:
        out.append(F.col("position"))
    if with_name:
        out.append(F.coalesce(REQUEST_ID, unnamed).alias("request_name"))
    return records.select(*out)


def quarantine(log: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """Log rows that yield no record or no prediction, with the reason."""
    bodies = parse_bodies(log, spec).select("request", "response", REQUEST_ID, "request_body", "response_body")
    no_records = F.coalesce(F.size(F.col(f"request_body.{RECORDS}")), F.lit(-1)) <= 0
    no_predictions = F.coalesce(F.size(F.col(f"response_body.{PREDICTIONS}")), F.lit(-1)) <= 0
    reason = F.when(no_records, "no records").when(no_predictions, "no predictions")
    return bodies.select(REQUEST_ID, "request", "response", reason.alias("reason")).filter(F.col("reason").isNotNull())


def payload_json(df: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """A single-record request body per row, as a scoring client sends it."""
    columns = [F.col(spec.key)] + [F.col(c).cast(T.DoubleType()).alias(c) for c in spec.features]
    body = F.to_json(F.struct(F.array(F.struct(*columns)).alias(RECORDS)))
    return df.select(spec.key, body.alias("request"))
