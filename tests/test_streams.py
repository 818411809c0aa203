import pytest
from pyspark.sql import functions as F

from checks.views import part, payload
from riskframe.operators.monitor import monitoring_rows, quality_profile
from riskframe.operators.payload import parse_payload
from riskframe.operators.split import split_bernoulli
from riskframe.schemas import log_schema
from riskframe.spec import CREDIT
from riskframe.streaming import ingest, quality, upsert
from riskframe.streaming.sinks import file_stream
from tests.conftest import SMALL


def test_ingest_in_batches_equals_one_split(spark, credit_rows, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    credit_rows.repartition(5).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        ingest.stream_ingest(file_stream(spark, source, credit_rows.schema, 2), root, mark)
    got = ingest.ingested(spark, root).select("Id", "split")
    want = split_bernoulli(credit_rows).select("Id", "split")
    assert sorted(got.collect()) == sorted(want.collect())
    assert ingest.streamed_features(spark, root).count() == credit_rows.count()


def test_versions_in_two_batches_leave_one_feature_row(spark, credit_rows, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    one = credit_rows.orderBy("Id").limit(3)
    newer = one.withColumns({"Limit_bal": F.lit(7.0), CREDIT.updated_at: F.col(CREDIT.updated_at) + F.expr("INTERVAL 1 DAY")})
    older = one.withColumns({"Limit_bal": F.lit(3.0), CREDIT.updated_at: F.col(CREDIT.updated_at) - F.expr("INTERVAL 1 DAY")})
    for rows in (one, newer, older):
        rows.coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            ingest.stream_ingest(file_stream(spark, source, credit_rows.schema, 1), root, mark)
    got = ingest.streamed_features(spark, root).collect()
    assert [r["Limit_bal"] for r in got] == [7.0] * 3 and ingest.ingested(spark, root).count() == 9


def test_unpublished_batches_are_not_seen(spark, credit_rows, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    credit_rows.limit(10).coalesce(1).write.parquet(source)
    with pytest.raises(FileNotFoundError):
        ingest.ingested(spark, root)
    ingest.stream_ingest(file_stream(spark, source, credit_rows.schema), root, mark)
    spark.read.parquet(f"{root}/rows").drop("batch").write.parquet(f"{root}/rows/batch=7")  # died before it was published
    assert ingest.ingested(spark, root).count() == 10


def shuffled_log(spark, path, per_batch=1):
    """Four files, one per batch, each with rows of all times; every request twice."""
    log = payload(spark, SMALL)
    log.union(log).repartition(4).write.parquet(path)
    return file_stream(spark, path, log_schema(), per_batch)


def test_repeated_and_late_records(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    stream = shuffled_log(spark, source)
    for _ in range(2):
        quality.drain_payload(stream, out, mark)
    got = quality.parsed_records(spark, out).drop("position")
    assert sorted(got.collect(), key=str) == sorted(parse_payload(payload(spark, SMALL)).collect(), key=str)


def test_repeated_batch_replaces_itself(spark, tmp_path):
    out, log = str(tmp_path / "out"), payload(spark, SMALL).limit(200)
    for batch_id in (0, 0, 1):
        quality.store_new(log, batch_id, out)
    assert quality.parsed_records(spark, out).count() == parse_payload(log).count()


def test_ledger_reads_the_hours_of_the_batch(spark, tmp_path):
    out, log = str(tmp_path / "out"), payload(spark, SMALL)
    quality.store_new(log, 0, out)
    schema = spark.read.option("basePath", out).parquet(out).schema
    hour = log.select(quality.log_hour()).first()[0]
    files = quality.ledger_rows(spark, out, [hour, "none", "1970010100"], schema).inputFiles()
    assert files and all(f"hour={hour}/" in f for f in files)
    assert quality.ledger_rows(spark, out, ["1970010100"], schema) is None


def test_requests_without_id_are_told_apart(spark, tmp_path):
    body = '{"dataframe_records": [{"Id": "%s"}]}'
    rows = [(None, 1_700_000_000_000, 5, body % i, '{"predictions": [1.0]}') for i in ("1", "2", "2")] + [(None, None, 5, body % "3", "{}")]
    log = spark.createDataFrame(rows, log_schema())
    out = str(tmp_path / "out")
    for batch_id in range(2):
        quality.store_new(log, batch_id, out)
    assert sorted(r["Id"] for r in quality.parsed_records(spark, out).collect()) == ["1", "2", "3"]


def test_all_windows_of_a_drained_log(spark, credit_rows, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    labels = [part(credit_rows, n) for n in ("train", "normal", "skewed")]
    quality.drain_quality(shuffled_log(spark, source), labels, out, mark)
    batch = quality_profile(monitoring_rows(parse_payload(payload(spark, SMALL)), labels))
    got = quality.window_quality(spark, out)
    assert sorted(got.select(batch.columns).collect()) == sorted(batch.collect())


def test_latest_value_table_and_snapshots(spark, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    rows = spark.range(600).select(
        (F.col("id") % 50).cast("string").alias("Id"), (F.col("id") * 37 % 601).alias("v"), F.col("id").alias("x"))
    want = sorted(rows.groupBy("Id").agg(F.max("v").alias("v"), F.max_by("x", "v").alias("x")).collect())
    rows.repartition(6).write.parquet(source)
    upsert.stream_upsert(file_stream(spark, source, rows.schema, 2), root, mark, version="v")
    assert sorted(upsert.latest(spark, root, version="v").collect()) == want
    assert upsert.compact(spark, root, version="v") == 2
    assert sorted(upsert.latest(spark, root, version="v").collect()) == want
    held, last = upsert.versions(spark, root)
    assert last == 2 and all("/snapshots/" in f for f in held.inputFiles())


def test_removed_keys_stay_removed(spark, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    schema = "Id string, v int, x int, gone boolean"

    def send(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        upsert.stream_upsert(file_stream(spark, source, spark.createDataFrame([], schema).schema), root, mark, version="v", deletes="gone")
        return sorted(map(tuple, upsert.latest(spark, root, version="v").collect()))

    assert send(("a", 1, 1, False), ("b", 1, 1, None), ("c", 2, 2, False)) == [("a", 1, 1), ("b", 1, 1), ("c", 2, 2)]
    assert send(("a", 5, 0, True), ("c", 2, 0, True)) == [("b", 1, 1)]  # of equal versions the removal wins
    upsert.compact(spark, root, version="v")
    assert send(("a", 3, 9, False)) == [("b", 1, 1)]  # older than the removal, and late
    held, _ = upsert.versions(spark, root)
    assert {"batch=2" in f or "/snapshots/upto=1/" in f for f in held.inputFiles()} == {True}
    assert send(("a", 6, 6, False)) == [("a", 6, 6), ("b", 1, 1)]
    upsert.compact(spark, root, version="v")
    assert sorted(map(tuple, upsert.latest(spark, root, version="v").collect())) == [("a", 6, 6), ("b", 1, 1)]
