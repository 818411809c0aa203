"""Whole jobs over catalog tables: what a second run has to bring in."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.views import part
from riskframe.plans import ingest, refresh
from riskframe.schemas import feature_table_schema
from riskframe.sources import scan, tables
from riskframe.spec import CREDIT


def stamped(rows, day):
    return rows.withColumn(CREDIT.updated_at, F.lit(datetime(2024, 1, day)))


def test_records_of_a_request_are_labelled_in_different_runs(spark, credit_rows):
    known = scan.conform(credit_rows, feature_table_schema())
    a, b = [r["Id"] for r in known.orderBy("Id").limit(2).collect()]
    body = '{"dataframe_records": [{"Id": "%s"}, {"Id": "%s"}]}' % (a, b)
    log = [(i, 1_700_000_000_000 + n, 5, body, '{"predictions": [1.0, 0.0]}') for n, i in enumerate(["r1", None])]
    schema = "databricks_request_id string, timestamp_ms long, execution_time_ms long, request string, response string"
    tables.overwrite_table(spark.createDataFrame(log, schema), "job_log")
    tables.overwrite_table(known, "job_features")
    run = lambda: refresh.refresh_monitor(spark, "job_log", ["job_labels"], "job_features", "job_monitoring")
    tables.overwrite_table(credit_rows.filter(F.col("Id") == a), "job_labels")
    assert [run(), run()] == [2, 0]
    tables.overwrite_table(credit_rows.filter(F.col("Id").isin(a, b)), "job_labels")
    assert [run(), run()] == [2, 0]
    got = scan.scan_table(spark, "job_monitoring").select("Id", "position", "prediction").collect()
    assert sorted(map(tuple, got)) == [(a, 0, 1.0)] * 2 + [(b, 1, 0.0)] * 2


def test_newer_versions_reach_the_features_once(spark, credit_rows):
    train, test = part(credit_rows, "train"), part(credit_rows, "test")
    tables.overwrite_table(stamped(train, 1), "ver_train")
    tables.overwrite_table(stamped(test, 1), "ver_test")
    tables.overwrite_table(scan.conform(train.unionByName(test), feature_table_schema()), "ver_features")
    old = train.orderBy("Id").limit(1)
    new = part(credit_rows, "normal").orderBy("Id").limit(1)
    limit = lambda rows, v: rows.withColumn("Limit_bal", F.lit(v))
    source = stamped(limit(old, 9.0), 3).unionByName(stamped(limit(new, 1.0), 3)).unionByName(stamped(limit(new, 2.0), 4))
    tables.overwrite_table(source, "ver_source")
    before = spark.table("ver_features").count()
    added = ingest.ingest(spark, "ver_source", "ver_train", "ver_test", "ver_features")
    assert added["ver_features"] == 2 and spark.table("ver_features").count() == before + 1
    ids = [old.first()["Id"], new.first()["Id"]]
    got = {r["Id"]: r["Limit_bal"] for r in spark.table("ver_features").filter(F.col("Id").isin(ids)).collect()}
    assert got == {ids[0]: 9.0, ids[1]: 2.0}
    assert set(ingest.ingest(spark, "ver_source", "ver_train", "ver_test", "ver_features").values()) == {0}
    assert not spark.catalog.tableExists("ver_features__staging")


def log_of(spark, days, ids):
    """One request per day and id."""
    body = lambda i: '{"dataframe_records": [{"Id": "%s"}]}' % i
    start = 1_700_000_000_000
    rows = [(f"{d}-{i}", start + d * 86_400_000, 5, body(i), '{"predictions": [1.0]}') for d in days for i in ids]
    schema = "databricks_request_id string, timestamp_ms long, execution_time_ms long, request string, response string"
    return refresh.with_day(spark.createDataFrame(rows, schema))


def test_refresh_touches_new_and_unlabelled_days_only(spark, credit_rows):
    known = scan.conform(credit_rows, feature_table_schema())
    a, b = [r["Id"] for r in known.orderBy("Id").limit(2).collect()]
    tables.overwrite_table(known, "day_features")
    tables.overwrite_table(credit_rows.filter(F.col("Id") == a), "day_labels")
    tables.overwrite_partitions(log_of(spark, range(3), [a]), "day_log", "day")
    tables.overwrite_partitions(log_of(spark, [3], [a, b]), "day_log", "day")
    run = lambda: refresh.refresh_monitor(spark, "day_log", ["day_labels"], "day_features", "day_monitoring")
    todo = lambda: refresh.days_to_do(spark, spark.table("day_log"), "day_monitoring__days")
    assert run() == 4
    fresh, days = todo()
    assert fresh == [] and len(days) == 1  # the day of b, which has no label
    tables.overwrite_partitions(log_of(spark, [4], [a]), "day_log", "day")
    fresh, days = todo()
    assert len(fresh) == 1 and len(days) == 2
    files = {f for d in range(3) for f in spark.table("day_monitoring").filter(F.col("day") == fresh[0].replace(day=14 + d)).inputFiles()}
    assert run() == 1 and files <= set(spark.table("day_monitoring").inputFiles())  # finished days were not written again
    tables.overwrite_table(credit_rows.filter(F.col("Id").isin(a, b)), "day_labels")
    assert [run(), run()] == [1, 0] and todo() == ([], [])
    assert spark.table("day_monitoring").count() == 6


def test_days_prune_partitions(spark, credit_rows):
    tables.overwrite_partitions(log_of(spark, range(5), ["1"]), "pruned_log", "day")
    days = [r["day"] for r in spark.table("pruned_log").select("day").distinct().orderBy("day").limit(2).collect()]
    rows = refresh.of_days(spark.table("pruned_log"), days)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan.replace("isnotnull(day", "day") and rows.count() == 2


def test_partitions_are_replaced_one_by_one(spark):
    rows = lambda *xs: spark.createDataFrame(list(xs), "x int, day string")
    tables.overwrite_partitions(rows((1, "a"), (2, "b")), "parted", "day")
    tables.overwrite_partitions(rows((3, "b"), (4, "c")).select("day", "x"), "parted", "day")
    assert sorted(map(tuple, spark.table("parted").collect())) == [(1, "a"), (3, "b"), (4, "c")]
    assert spark.conf.get(tables.DYNAMIC).lower() == "static"


def test_repeated_records_count_once(spark, credit_rows):
    known = scan.conform(credit_rows, feature_table_schema())
    a = known.orderBy("Id").first()["Id"]
    tables.overwrite_table(known, "twice_features")
    tables.overwrite_table(credit_rows, "twice_labels")
    log = log_of(spark, [0, 1], [a])
    tables.overwrite_table(log.unionByName(log), "twice_log")
    assert refresh.refresh_monitor(spark, "twice_log", ["twice_labels"], "twice_features", "twice_monitoring") == 2
    nothing = log.withColumn("request", F.lit("not json"))
    tables.overwrite_table(nothing, "broken_log")
    for _ in range(2):
        assert refresh.refresh_monitor(spark, "broken_log", ["twice_labels"], "twice_features", "broken_monitoring") == 0
