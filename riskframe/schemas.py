"""Declared schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

from riskframe.spec import CREDIT, RAW_COLUMNS, RAW_INTEGER, RAW_TARGET, TableSpec


def raw_schema() -> T.StructType:
    """Schema of the raw CSV extract."""
    fields = [T.StructField(c, T.IntegerType() if c in RAW_INTEGER else T.DoubleType()) for c in RAW_COLUMNS]
    return T.StructType([*fields, T.StructField(RAW_TARGET, T.IntegerType())])


def feature_table_schema(spec: TableSpec = CREDIT) -> T.StructType:
    """Keyed feature table: non-null string key and one double per feature."""
    doubles = [T.StructField(c, T.DoubleType()) for c in spec.features]
    return T.StructType([T.StructField(spec.key, T.StringType(), False), *doubles])


# Field names of the inference log and of its JSON bodies.
REQUEST_ID = "databricks_request_id"
LOG_FIELDS = ["request", "response", "timestamp_ms", REQUEST_ID, "execution_time_ms"]
RECORDS = "dataframe_records"
PREDICTIONS = "predictions"
OUTPUT = "databricks_output"


def log_schema() -> T.StructType:
    return (
        T.StructType()
        .add(REQUEST_ID, T.StringType())
        .add("timestamp_ms", T.LongType())
        .add("execution_time_ms", T.LongType())
        .add("request", T.StringType())
        .add("response", T.StringType())
    )


def request_schema(spec: TableSpec = CREDIT) -> T.StructType:
    """Body of one scoring request: a list of keyed feature records."""
    return T.StructType([T.StructField(RECORDS, T.ArrayType(T.StructType(
        [T.StructField(spec.key, T.StringType()), *(T.StructField(c, T.DoubleType()) for c in spec.features)]
    )))])


def response_schema() -> T.StructType:
    """Body of one scoring response: a list of predictions and a trace."""
    output = T.StructType().add("trace", T.StringType()).add(REQUEST_ID, T.StringType())
    return T.StructType().add(PREDICTIONS, T.ArrayType(T.DoubleType())).add(OUTPUT, output)
