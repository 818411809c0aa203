from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES, loaded
from checks.views import part
from riskframe.operators import features
from riskframe.plans import ingest, prepare
from riskframe.schemas import feature_table_schema
from riskframe.sources import scan, tables
from riskframe.spec import CREDIT
from tests.conftest import SMALL


def test_append_and_insert_match_by_name(spark):
    tables.overwrite_table(spark.createDataFrame([("1", 2.0)], "Id string, x double"), "by_name")
    assert tables.append_table(spark.createDataFrame([(4, "3")], "x int, Id string"), "by_name") == 1
    tables.insert_by_name(spark, "by_name", "SELECT 6.5D AS x, '5' AS Id WHERE 1 < :n", n=2)
    assert sorted(spark.table("by_name").collect()) == [("1", 2.0), ("3", 4.0), ("5", 6.5)]


def test_rewrite_reads_its_own_target(spark):
    tables.overwrite_table(spark.range(5), "rewritten")
    tables.rewrite_table(spark.table("rewritten").filter("id > 2"), "rewritten")
    assert sorted(r[0] for r in spark.table("rewritten").collect()) == [3, 4]
    assert not spark.catalog.tableExists("rewritten__staging")


def test_keyed_table_refuses_null_keys(spark):
    rows = spark.createDataFrame([("1", 1.0), (None, 2.0)], "Id string, x double")
    with pytest.raises(Exception, match="null key Id"):
        tables.create_keyed_table(rows, "keyed", "Id")
    tables.create_keyed_table(rows.dropna(), "keyed", "Id")
    assert spark.table("keyed").count() == 1


def test_names_with_hyphens(spark):
    spark.range(3).createOrReplaceTempView("`model-serving-log`")
    assert scan.scan_table(spark, "model-serving-log").count() == 3
    assert scan.scan_table(spark, "`model-serving-log`").count() == 3


def at(day):
    return F.lit(datetime(2024, 1, day))


def stamped(rows, day):
    return rows.withColumn(CREDIT.updated_at, at(day))


def test_incremental_load_runs_once(spark, credit_rows):
    train, test, fresh = (part(credit_rows, n) for n in ("train", "test", "normal"))
    tables.overwrite_table(stamped(train, 1), "inc_train")
    tables.overwrite_table(stamped(test, 2), "inc_test")
    source = stamped(fresh, 3).unionByName(stamped(train, 2))
    tables.overwrite_table(source, "inc_source")
    tables.overwrite_table(scan.conform(train, feature_table_schema()), "inc_features")
    before = spark.table("inc_train").count(), spark.table("inc_test").count()
    n = fresh.count()

    added = ingest.ingest(spark, "inc_source", "inc_train", "inc_test", "inc_features")
    assert added["inc_features"] == n and added["inc_train"] + added["inc_test"] == n
    assert spark.table("inc_train").count() == before[0] + added["inc_train"]
    assert features.absent_from(spark.table("inc_source"), spark.table("inc_features")).isEmpty()
    again = ingest.ingest(spark, "inc_source", "inc_train", "inc_test", "inc_features")
    assert set(again.values()) == {0}


def test_interrupted_load_is_finished(spark, credit_rows):
    """A run died after the feature table and the train set were written."""
    train, test, fresh = (part(credit_rows, n) for n in ("train", "test", "skewed"))
    tables.overwrite_table(stamped(train, 1), "cut_train")
    tables.overwrite_table(stamped(test, 1), "cut_test")
    tables.overwrite_table(stamped(fresh, 3), "cut_source")
    tables.overwrite_table(scan.conform(train, feature_table_schema()), "cut_features")
    batch = ingest.incoming(*(spark.table(t) for t in ("cut_source", "cut_train", "cut_test")))
    tables.overwrite_table(batch, "cut_train__pending")
    pending = spark.table("cut_train__pending")
    tables.append_table(pending.select(*CREDIT.clean), "cut_features")
    tables.append_table(pending.filter("split = 'train'").drop("split"), "cut_train")

    added = ingest.ingest(spark, "cut_source", "cut_train", "cut_test", "cut_features")
    assert added["cut_features"] == 0 and added["cut_train"] == 0
    assert added["cut_test"] == spark.table("cut_test").filter(F.col(CREDIT.updated_at) == at(3)).count()
    loaded = spark.table("cut_train").unionByName(spark.table("cut_test")).select("Id")
    assert fresh.select("Id").exceptAll(loaded).isEmpty()


def test_mark_of_empty_tables_takes_everything(credit_rows):
    none = credit_rows.limit(0)
    assert features.high_water_mark(none, none).first()[0] is None
    assert features.new_rows(credit_rows, none, none).count() == credit_rows.count()
    top = credit_rows.agg(F.max(CREDIT.updated_at)).first()[0]
    rest = features.new_rows(credit_rows, credit_rows, none)
    assert rest.isEmpty() and top is not None


def test_semi_join_equals_inner_join_form(credit_rows):
    train, test = part(credit_rows, "train"), part(credit_rows, "test")
    mark = features.high_water_mark(train.filter(F.col(CREDIT.updated_at) < "2000-06-01"))
    got = features.feature_insert(credit_rows, train, test, mark)
    m = mark.first()[0]
    new = train.unionByName(test).filter(F.col(CREDIT.updated_at) > m).select("Id", F.lit(1).alias("one"))
    want = credit_rows.filter(F.col(CREDIT.updated_at) > m).join(new, "Id").select(*CREDIT.clean).distinct()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_features_of_every_new_row(spark):
    source, train, test = loaded(spark, SMALL)
    got = QUERIES["feature_insert"](spark, SMALL)
    want = features.new_rows(source, train, test).select("Id")
    assert got.select("Id").exceptAll(want).isEmpty() and want.exceptAll(got.select("Id")).isEmpty()
    assert {r[0][-1] for r in got.select("Id").collect()} >= {"7", "8", "9"}


def test_change_feed_with_nulls_and_upsert(spark):
    old = spark.createDataFrame([("1", 1.0), ("2", None), ("3", 3.0), ("4", None)], "Id string, x double")
    new = spark.createDataFrame([("1", 1.0), ("2", None), ("4", 4.0), ("5", None)], "Id string, x double")
    got = sorted(map(tuple, features.change_feed(old, new).collect()))
    assert got == [("3", "delete", 3.0), ("4", "update", 4.0), ("5", "insert", None)]
    current = spark.createDataFrame([("a", 1, 10), ("b", 5, 20)], "Id string, v int, x int")
    changes = spark.createDataFrame([("a", 1, 11, False), ("b", 4, 21, False), ("c", 1, 1, False), ("c", 2, 2, True)],
                                    "Id string, v int, x int, gone boolean")
    merged = features.upsert_latest(current, changes, version="v", deletes="gone")
    assert sorted(map(tuple, merged.collect())) == [("a", 1, 11), ("b", 5, 20)]


def test_lookup_leaves_synthetic_rows_out(spark, train):
    store = prepare.feature_table(train)
    tables.create_keyed_table(store, "balanced", "Id")
    store = spark.table("balanced")
    assert store.count() > train.count()
    rows = prepare.training_set(train, store)
    assert rows.count() == train.count()
    assert rows.columns == ["Id", "Default", *CREDIT.features]
    assert ingest.insert_inference_rows(spark, train, "balanced") == 0


def test_new_ids_never_collide(spark, train):
    rows = features.new_ids(train.select("Id", "Age"), train)
    top = train.agg(F.max(F.col("Id").cast("int"))).first()[0]
    got = sorted(int(r["Id"]) for r in rows.collect())
    assert got == list(range(top + 1, top + 1 + train.count()))
    odd = spark.createDataFrame([("x",), ("7",)], "Id string")
    assert features.max_key(odd).first()[0] == 7
    assert features.max_key(odd.limit(0)).first()[0] == 0
