"""Inference log to monitoring table, windowed quality and alert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.monitor import accuracy_alert, monitoring_rows, quality_profile
from riskframe.operators.payload import log_second, parse_payload
from riskframe.operators.profile import require_unique_key
from riskframe.sources.scan import scan_table
from riskframe.sources.tables import overwrite_partitions, quoted
from riskframe.spec import CREDIT, TableSpec

DAY = "day"
#: Records without a time belong to this day.
NO_DAY = date(1970, 1, 1)


def monitored(
    log: DataFrame, labels: Sequence[DataFrame], features: DataFrame | None = None, spec: TableSpec = CREDIT
) -> DataFrame:
    """Parse the log and attach labels and features, as one lazy plan."""
    return monitoring_rows(parse_payload(log, spec=spec), labels, features, spec)


def quality(log: DataFrame, labels: Sequence[DataFrame], spec: TableSpec = CREDIT) -> DataFrame:
    """Windowed quality of the logged predictions."""
    return quality_profile(monitored(log, labels, spec=spec))


def log_day(ms: Column) -> Column:
    return F.coalesce(F.to_date(log_second(ms)), F.lit(NO_DAY))


def with_day(log: DataFrame) -> DataFrame:
    """The log with its day: its own column, best a partition, or else the day of its time."""
    return log if DAY in log.columns else log.withColumn(DAY, log_day(F.col("timestamp_ms")))


def of_days(rows: DataFrame, days: Sequence[date]) -> DataFrame:
    return rows.filter(F.col(DAY).isin(list(days)))


def day_counts(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(DAY).agg(F.count(F.lit(1)).alias(name))


def days_to_do(spark: SparkSession, log: DataFrame, state: str) -> tuple[list[date], list[date]]:
    """Days whose log rows are not those last seen, and these together with days that have unlabelled records.

    Counting reads no column of a log partitioned by day, and one otherwise. One row per day reaches the driver.
    """
    seen = {}
    if spark.catalog.tableExists(quoted(state)):
        seen = {r[DAY]: (r["log_rows"], r["open_rows"]) for r in scan_table(spark, state).collect()}
    there = {r[DAY]: r["log_rows"] for r in day_counts(log, "log_rows").collect()}
    fresh = sorted(d for d, n in there.items() if seen.get(d, (None, 0))[0] != n)
    return fresh, sorted({*fresh, *(d for d, (_, n) in seen.items() if n)})


def refresh_monitor(
    spark: SparkSession, log: str, labels: Sequence[str], features: str, target: str, spec: TableSpec = CREDIT
) -> int:
    """Bring the monitoring table up to date; returns how many rows it gained.

    Every day of the log is parsed once, into ``<target>__parsed``; both tables are partitioned by day. A run parses days
    whose log rows changed in number and rewrites the monitoring rows of these days and of days with records that had no
    label yet; no other day of the log, the parse or the target is read. Records repeated in the log, known by request and
    position, count once a day. ``<target>__days`` is written last, so a run that died is done again.
    """
    parsed_name, state = (f"{target.strip('`')}__{x}" for x in ("parsed", "days"))
    known = require_unique_key(scan_table(spark, features), spec.key)
    dated = with_day(scan_table(spark, log))
    fresh, todo = days_to_do(spark, dated, state)
    if not todo:
        return 0
    if fresh:
        parsed = parse_payload(of_days(dated, fresh), spec=spec, with_position=True, with_name=True)
        once = parsed.withColumn(DAY, log_day(F.col("timestamp_ms"))).dropDuplicates([DAY, "request_name", "position"])
        overwrite_partitions(once, parsed_name, DAY)
    if not spark.catalog.tableExists(quoted(parsed_name)):
        return 0  # nothing but broken bodies so far
    parsed = of_days(scan_table(spark, parsed_name), todo)
    before = of_days(scan_table(spark, target), todo).count() if spark.catalog.tableExists(quoted(target)) else 0
    rows = monitoring_rows(parsed.drop("request_name"), [scan_table(spark, n) for n in labels], known, spec)
    overwrite_partitions(rows, target, DAY)
    done = day_counts(of_days(scan_table(spark, target), todo), "done_rows")
    usable = day_counts(parsed.filter(F.col("prediction").isNotNull() & F.col(spec.key).isNotNull()), "usable_rows")
    counted = day_counts(of_days(dated, todo), "log_rows").join(usable, DAY, "left").join(done, DAY, "left")
    still_open = F.coalesce("usable_rows", F.lit(0)) - F.coalesce("done_rows", F.lit(0))
    overwrite_partitions(counted.select("log_rows", still_open.alias("open_rows"), DAY), state, DAY)
    return of_days(scan_table(spark, target), todo).count() - before


def alerts(spark: SparkSession, target: str) -> DataFrame:
    """Windows of the monitoring table with too low accuracy."""
    return accuracy_alert(quality_profile(scan_table(spark, target)))
