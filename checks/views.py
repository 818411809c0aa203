"""Views over the given tables that the registered queries start from.

``credit_raw`` has one row per customer in the shape of the raw extract; ``payload`` has one
inference-log row per event. ``CREDIT_SQL`` and ``PAYLOAD_SQL`` are the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.clean import clean
from riskframe.session import scratch_path
from riskframe.spec import CREDIT, FEATURES, RAW_COLUMNS, RAW_TARGET

KS = [0, 2, 3, 4, 5, 6]
YEARS = range(1, 7)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sums(alias: str, condition: str) -> list[str]:
    return [
        f"ROUND(SUM(CASE WHEN YEAR(o_orderdate) = {1994 + i}{condition} THEN o_totalprice ELSE 0 END), 2) AS {alias}{i}"
        for i in YEARS
    ]


ORDER_SUMS = _sums("BILL_AMT", "") + _sums("PAY_AMT", " AND o_orderstatus = 'F'")
RAW_EXPRESSIONS = [
    "CAST(c_custkey AS INT) AS ID",
    "c_acctbal AS LIMIT_BAL",
    "CAST(1 + c_custkey % 2 AS INT) AS SEX",
    "CAST(c_custkey % 7 AS INT) AS EDUCATION",
    "CAST(c_custkey % 4 AS INT) AS MARRIAGE",
    "CAST(21 + (c_custkey * 13) % 56 AS INT) AS AGE",
    *(f"CAST((c_custkey * {7 + i} + {i}) % 11 - 2 AS INT) AS PAY_{i}" for i in KS),
    *(f"BILL_AMT{i}" for i in YEARS),
    *(f"PAY_AMT{i}" for i in YEARS),
]
LATE = "CAST(CASE WHEN ((c_custkey * 7) % 11 - 2 >= 6) <> (c_custkey % 5 = 0) THEN 1 ELSE 0 END AS INT)"


def credit_raw(spark: SparkSession, sf_dir: str, stamped: bool = False) -> DataFrame:
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.expr("CAST(MAX(o_orderdate) AS TIMESTAMP)").alias(CREDIT.updated_at), *map(F.expr, ORDER_SUMS)
    )
    columns = [*RAW_EXPRESSIONS, f"{LATE} AS `{RAW_TARGET}`"] + ([CREDIT.updated_at] if stamped else [])
    return table(spark, sf_dir, "customer").join(sums, F.expr("c_custkey = o_custkey")).selectExpr(*columns)


STAGED: dict[tuple[str, str], str] = {}


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows with their update time.

    The jobs find these rows in stored tables, so they are written to the shared folder when a session
    first asks for them, and read from there afterwards.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    try:
        return spark.read.parquet(STAGED[key])
    except (KeyError, AnalysisException):
        STAGED[key] = scratch_path(spark, "credit")
        clean(credit_raw(spark, sf_dir, stamped=True)).write.parquet(STAGED[key])
        return spark.read.parquet(STAGED[key])


SLICES = {"train": [0, 1, 2, 3, 4], "test": [5, 6], "normal": [7, 8], "skewed": [9]}


def part(df: DataFrame, name: str) -> DataFrame:
    """One of the four label tables."""
    return df.filter((F.col("Id").cast("bigint") % 10).isin(SLICES[name]))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    request_id = F.concat(F.lit("req-"), i.cast("string"))
    body = F.concat(
        F.lit('{"dataframe_records": [{"Id": "'),
        F.col("user_id").cast("string"),
        F.lit('", "Limit_bal": '),
        F.col("value").cast("string"),
        F.lit("}]}"),
    )
    answer = F.when(i % 89 == 0, "[]").otherwise(
        F.when(F.col("event_type").isin("purchase", "error"), "[1.0]").otherwise("[0.0]")
    )
    return e.select(
        request_id.alias("databricks_request_id"),
        F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000").alias("timestamp_ms"),
        (i % 200).alias("execution_time_ms"),
        F.when(i % 97 == 0, "not json").otherwise(body).alias("request"),
        F.concat(
            F.lit('{"predictions": '),
            answer,
            F.lit(', "databricks_output": {"trace": null, "databricks_request_id": "'),
            request_id,
            F.lit('"}}'),
        ).alias("response"),
    )


CREDIT_RAW_SQL = f"""
b AS (SELECT o_custkey, MAX(o_orderdate) AS ts, {", ".join(ORDER_SUMS)} FROM orders GROUP BY o_custkey),
credit_raw AS (
  SELECT {", ".join(RAW_EXPRESSIONS)}, {LATE} AS "{RAW_TARGET}", ts AS Update_timestamp_utc
  FROM customer JOIN b ON c_custkey = o_custkey
)"""


def _corrected(raw: str, name: str) -> str:
    if name == "Id":
        return "CAST(ID AS VARCHAR) AS Id"
    if name == "Education":
        return "CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS Education"
    if name == "Marriage":
        return "CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END AS Marriage"
    if name.startswith("Pay"):
        return f"CASE WHEN {raw} IN (-1, -2) THEN 0 ELSE {raw} END AS {name}"
    return f"{raw} AS {name}"


CREDIT_SQL = f"""{CREDIT_RAW_SQL},
credit AS (
  SELECT {", ".join(_corrected(c, c.capitalize()) for c in RAW_COLUMNS)},
         "{RAW_TARGET}" AS "Default", Update_timestamp_utc
  FROM credit_raw
)""" + "".join(
    f""",
{name} AS (SELECT * FROM credit WHERE CAST(Id AS BIGINT) % 10 IN ({", ".join(map(str, digits))}))"""
    for name, digits in SLICES.items()
)

PAYLOAD_SQL = """
payload AS (
  SELECT concat('req-', CAST(event_id AS VARCHAR)) AS databricks_request_id,
         epoch_us(ts) // 1000 AS timestamp_ms, event_id % 200 AS execution_time_ms,
         CASE WHEN event_id % 97 = 0 THEN 'not json'
              ELSE concat('{"dataframe_records": [{"Id": "', CAST(user_id AS VARCHAR), '", "Limit_bal": ',
                          CAST(value AS VARCHAR), '}]}') END AS request,
         concat('{"predictions": ',
                CASE WHEN event_id % 89 = 0 THEN '[]'
                     WHEN event_type IN ('purchase', 'error') THEN '[1.0]' ELSE '[0.0]' END,
                ', "databricks_output": {"trace": null, "databricks_request_id": "req-',
                CAST(event_id AS VARCHAR), '"}}') AS response
  FROM events
)"""

FEATURE_SQL = ", ".join(FEATURES)
