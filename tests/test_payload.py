import json

from pyspark.sql import functions as F

from checks.views import part, payload
from riskframe.operators import monitor
from riskframe.operators.payload import parse_payload, payload_json, quarantine
from riskframe.operators.skew import hot_keys, salted_join
from riskframe.plans import refresh
from riskframe.schemas import feature_table_schema, log_schema
from riskframe.sources import scan, tables
from riskframe.spec import FEATURES
from tests.conftest import SMALL


def log(spark, *bodies):
    rows = [(f"r{i}", 1_700_000_000_123 + i, 5, req, res) for i, (req, res) in enumerate(bodies)]
    return spark.createDataFrame(rows, log_schema())


def ask(*ids):
    return json.dumps({"dataframe_records": [{"Id": i, "Age": 30.0} for i in ids]})


def answer(*values):
    return json.dumps({"predictions": list(values), "databricks_output": {"trace": None}})


def test_records_get_their_own_prediction(spark):
    df = log(spark, (ask("1", "2", "3"), answer(1.0, 0.0)))
    rows = sorted((r["Id"], r["prediction"]) for r in parse_payload(df).collect())
    assert rows == [("1", 1.0), ("2", 0.0), ("3", None)]
    first = parse_payload(df, first_prediction=True).collect()
    assert {r["prediction"] for r in first} == {1.0}
    assert first[0]["timestamp"].microsecond == 0 and first[0]["timestamp_ms"] == 1_700_000_000_123


def test_broken_bodies_are_set_aside(spark):
    df = log(spark, ("not json", answer(1.0)), (ask("1"), answer()), (ask(), answer(1.0)), (ask("2"), "{"), (ask("3"), answer(0.0)))
    got = {r["databricks_request_id"]: r["reason"] for r in quarantine(df).collect()}
    assert got == {"r0": "no records", "r1": "no predictions", "r2": "no records", "r3": "no predictions"}
    parsed = {r["Id"]: r["prediction"] for r in parse_payload(df).collect()}
    assert parsed == {"1": None, "2": None, "3": 0.0}


def test_request_text_reads_back(spark, credit_rows):
    bodies = payload_json(credit_rows).join(credit_rows.select("Id", *FEATURES), "Id").collect()
    for r in bodies[:50]:
        (record,) = json.loads(r["request"])["dataframe_records"]
        assert record == {"Id": r["Id"], **{c: float(r[c]) for c in FEATURES}}


def test_earliest_table_knows_the_label(spark):
    a = spark.createDataFrame([("1", 1), ("2", None)], "Id string, Default int")
    b = spark.createDataFrame([("1", 0), ("2", 0), ("3", 1), ("3", 1)], "Id string, Default int")
    got = {r["Id"]: r["default"] for r in monitor.known_labels(a, b).collect()}
    assert got == {"1": 1.0, "2": 0.0, "3": 1.0}


def test_hot_key_is_spread_and_nothing_lost(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    right = spark.range(0, 3000, 2).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")).union(
        spark.createDataFrame([("hot", 9)], "k string, v int"))
    assert [r["k"] for r in hot_keys(left, "k").collect()] == ["hot"]
    for how in ("left", "inner"):
        got = salted_join(left, right, "k", "n", how)
        assert sorted(got.collect(), key=str) == sorted(left.join(right, "k", how).collect(), key=str)


def test_refresh_adds_every_request_once(spark, credit_rows):
    payload(spark, SMALL).createOrReplaceTempView("`monitor-log_payload`")
    for n in ("train", "normal", "skewed"):
        tables.overwrite_table(part(credit_rows, n), f"mon_{n}")
    tables.overwrite_table(scan.conform(credit_rows, feature_table_schema()), "mon_features")
    names = ["mon_train", "mon_normal", "mon_skewed"]
    n = refresh.refresh_monitor(spark, "monitor-log_payload", names, "mon_features", "mon_rows")
    assert n == 855
    assert refresh.refresh_monitor(spark, "monitor-log_payload", names, "mon_features", "mon_rows") == 0
    rows = spark.table("mon_rows")
    assert rows.count() == 855 and rows.filter("Age is null").isEmpty()
    quality = monitor.quality_profile(rows)
    assert quality.count() == 646
    assert quality.filter("tp + fp + fn + tn <> rows").isEmpty()
    assert refresh.alerts(spark, "mon_rows").count() == quality.filter("accuracy_score < 0.42").count()
