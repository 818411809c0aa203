import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskframe.operators import split
from riskframe.operators.ranking import hash_ranked
from riskframe.plans import prepare


def ids(df, part):
    return {r["Id"] for r in df.filter(F.col("split") == part).collect()}


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(1003).select(F.col("id").cast("string").alias("Id"), (F.col("id") % 3 == 0).cast("int").alias("Default"))


def test_exact_sizes_and_partitioning(keys):
    a, b = split.split_exact(keys), split.split_exact(keys.repartition(7))
    assert len(ids(a, "test")) == math.ceil(0.2 * 1003)
    assert len(ids(a, "train")) == 1003 - math.ceil(0.2 * 1003)
    assert ids(a, "test") == ids(b, "test")
    assert not ids(a, "test") & ids(a, "train")
    assert ids(split.split_exact(keys, seed=7), "test") != ids(a, "test")


def test_stratified_sizes(keys):
    df = split.split_stratified(keys)
    for label, n in ((1, 335), (0, 668)):
        rows = df.filter(F.col("Default") == label)
        low, high = math.ceil(0.15 * n), math.ceil(0.30 * n)
        assert [len(ids(rows, p)) for p in ("test", "val", "train")] == [low, high - low, n - high]


def test_hot_key_stays_together(spark):
    """A third of all rows share one key."""
    hot = spark.range(500).select(F.lit("hot").alias("Id"))
    df = split.split_exact(hot.union(spark.range(1000).select(F.col("id").cast("string"))))
    assert df.count() == 1500
    assert df.filter("Id = 'hot'").select("split").distinct().count() == 1


def test_bernoulli_is_near_the_share(keys):
    df = split.split_bernoulli(keys)
    n = len(ids(df, "train"))
    assert 740 < n < 860
    assert ids(split.split_bernoulli(keys.repartition(5)), "train") == ids(df, "train")


def test_ranks_are_a_permutation(keys):
    ranks = sorted(r["rank"] for r in hash_ranked(keys, "Id", 42).collect())
    assert ranks == list(range(1, 1004))


def test_sample_with_replacement(keys):
    rows = split.sample_with_replacement(keys, 2000).collect()
    assert sorted(r["draw"] for r in rows) == list(range(2000))
    assert 700 < len({r["Id"] for r in rows}) < 1003


def test_slices(keys):
    order = sorted(str(i) for i in range(1003))
    assert [r["Id"] for r in split.head_rows(keys, 3).collect()] == order[:3]
    assert [r["Id"] for r in split.head_rows(keys, 3, tail=True).collect()] == order[::-1][:3]
    assert [r["Id"] for r in split.row_slice(keys, 112, 113).collect()] == order[112:113]


def test_prepare_tables(spark, tmp_path):
    from checks.views import credit_raw
    from tests.conftest import SMALL

    path = str(tmp_path / "extract")
    credit_raw(spark, SMALL).write.option("header", True).csv(path)
    prepare.prepare_tables(spark, path, "prep_train", "prep_test", datetime(2024, 1, 1))
    train, test = spark.table("prep_train"), spark.table("prep_test")
    assert test.count() == math.ceil(0.2 * 150) and train.count() == 150 - test.count()
    assert train.select("Update_timestamp_utc").distinct().first()[0] == datetime(2024, 1, 1)
