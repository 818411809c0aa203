import pytest
from pyspark.sql import functions as F

from riskframe.operators import ordered, positions, split


@pytest.fixture(autouse=True, scope="module")
def many_ranges(spark):
    """Small tables would be put into one range otherwise."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one key, some have none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("k05")).when(n % 101 != 0, F.format_string("k%02d", (n * 37) % 90))
    return spark.range(3_000).select(key.alias("Id"), n.alias("v")).repartition(7)


def test_positions_are_consecutive_and_ordered(rows):
    got = sorted(positions.positions(rows, ["Id"], first=5).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(5, 3_005))
    keys = [r["Id"] or "" for r in got]
    assert keys == sorted(keys) and len({r["v"] for r in got}) == 3_000


def test_frequent_key_is_cut_into_ranges(rows):
    placed = positions.ranged(rows, ["Id"])
    assert placed.filter("Id = 'k05'").select("_range").distinct().count() > 1
    assert placed.count() == 3_000


@pytest.mark.parametrize(("start", "stop"), [(0, 10), (0, 3_000), (25, 40), (1_000, 1_003), (2_990, 9_999), (5_000, 5_001), (7, 7), (9, 3)])
def test_slices(rows, start, stop):
    want = sorted(r["Id"] or "" for r in rows.collect())[start:max(start, stop)]
    got = split.row_slice(rows, start, stop).collect()
    assert sorted(r["Id"] or "" for r in got) == want


def test_slice_of_nothing(spark):
    none = spark.createDataFrame([], "Id string, v int")
    assert split.row_slice(none, 0, 5).collect() == []
    assert positions.positions(none, ["Id"]).collect() == []


def test_cut_groups_carry_their_sums(spark):
    """Quantiles of a group that spans all ranges, beside small ones."""
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 50 == 0, F.col("id") % 3).otherwise(9).alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("x"))
    got = {r["g"]: (r["q25"], r["q50"], r["q75"]) for r in ordered.quartiles(df, ["x"], ["g"]).collect()}
    want = df.toPandas().groupby("g")["x"].quantile([0.25, 0.5, 0.75]).unstack()
    assert {g: tuple(row) for g, row in want.iterrows()} == got
    whole = ordered.quartiles(df, ["x"]).first()
    assert tuple(df.toPandas()["x"].quantile([0.25, 0.5, 0.75])) == (whole["q25"], whole["q50"], whole["q75"])


def test_running_sums_within_groups(spark):
    n = 40_000
    df = spark.range(n).select((F.col("id") % 4 == 0).cast("int").alias("g"), F.col("id").alias("x"), (F.col("id") % 10).alias("w"), F.lit(1).alias("one"))
    got = positions.running(df, ["g"], "x", ["w", "one"]).toPandas().sort_values(["g", "x"])
    pdf = df.toPandas().sort_values(["g", "x"])
    assert (got["w_upto"].to_numpy() == pdf.groupby("g")["w"].cumsum().to_numpy()).all()
    assert (got["one_upto"].to_numpy() == pdf.groupby("g")["one"].cumsum().to_numpy()).all()
    assert (got["w_all"].to_numpy() == pdf.groupby("g")["w"].transform("sum").to_numpy()).all()
