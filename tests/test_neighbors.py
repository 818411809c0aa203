import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.balance import smote_balance
from riskframe.operators.projections import near_by_projections
from riskframe.operators.neighbors import Best, bounds, meet, nearest
from riskframe.spec import FEATURES


def brute(pdf, columns, k):
    """{(id, rank): (neighbour, distance)} by comparing everything."""
    x, ids, out = pdf[columns].to_numpy(float), pdf["Id"].tolist(), {}
    for i, me in enumerate(ids):
        d = np.zeros(len(ids))
        for j in range(len(columns)):
            d += (x[i, j] - x[:, j]) ** 2
        order = sorted((d[n], ids[n]) for n in range(len(ids)) if n != i)[:k]
        out.update({(me, r + 1): (n, np.sqrt(v)) for r, (v, n) in enumerate(order)})
    return out


def same(df, columns, k=5, **sizes):
    got = {(r["Id"], r["rank"]): (r["neighbour"], r["distance"]) for r in nearest(df, columns, k=k, **sizes).collect()}
    assert got == brute(df.toPandas(), columns, k)


def cloud(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        i.cast("string").alias("Id"),
        ((i * 7919) % 1013 + F.when(i % 5 == 0, 4000).otherwise(0)).cast("double").alias("x"),
        ((i * 104729) % 977).cast("double").alias("y"),
        ((i * 31) % 11).cast("double").alias("z"),
    )


def test_equals_brute_force(spark):
    same(cloud(spark, 600), ["x", "y", "z"])


def test_split_cells_and_visitors(spark):
    """Few pivots, tiny blocks and chunks: every cell is cut up and every crowd divided."""
    same(cloud(spark, 400), ["x", "y", "z"], max_pivots=3, block=16, chunk=32)


def test_a_third_are_copies(spark):
    df = cloud(spark, 300)
    copies = spark.range(150).select(
        F.concat(F.lit("c"), F.col("id")).alias("Id"), F.lit(17.0).alias("x"), F.lit(5.0).alias("y"), F.lit(1.0).alias("z")
    )
    same(df.union(copies), ["x", "y", "z"], block=32)


def test_ties_go_to_the_smaller_key(spark):
    grid = spark.range(81).select(
        F.col("id").cast("string").alias("Id"), (F.col("id") % 9).cast("double").alias("x"),
        F.floor(F.col("id") / 9).cast("double").alias("y"),
    )
    same(grid, ["x", "y"], k=4)


def test_few_pairs_are_measured():
    """On independent columns no block can be left out, but few pairs need more than the matrix product."""
    x, k = np.random.default_rng(3).normal(size=(4000, 64)), 5
    best, measured = Best(bounds(x[:500], x[:500], k), k), 0
    for i in range(0, 4000, 500):
        y = x[i : i + 500]
        centre = y.mean(axis=0)
        radius = np.sqrt(((y - centre) ** 2).sum(axis=1).max())
        measured += meet(best, x[:500], y, np.ones(500, int), np.arange(i, i + 500), centre, radius)
    d = sum((x[:500, j, None] - x[None, :, j]) ** 2 for j in range(64))
    assert (best.d2 == np.sort(d, axis=1)[:, : k + 1]).all() and (best.place == np.argsort(d, axis=1)[:, : k + 1]).all()
    assert measured < 0.02 * d.size


def test_few_rows(spark):
    same(cloud(spark, 6), ["x", "y", "z"])
    with pytest.raises(ValueError, match="too few"):
        nearest(cloud(spark, 5), ["x", "y", "z"])


def test_balance(train):
    before = {r[0]: r[1] for r in train.groupBy("Default").count().collect()}
    rows = smote_balance(train)
    after = {r[0]: r[1] for r in rows.groupBy("Default").count().collect()}
    assert after == dict.fromkeys(before, max(before.values()))
    assert rows.select("Id").distinct().count() == rows.count()
    top = train.agg(F.max(F.col("Id").cast("int"))).first()[0]
    made = rows.filter(F.col("Id").cast("int") > top)
    assert made.count() == max(before.values()) - min(before.values())
    # Between two minority rows: no column leaves the range of the minority.
    few = min(before, key=before.get)
    spans = train.filter(F.col("Default") == few).agg(*(F.min(c).alias(f"l{c}") for c in FEATURES), *(F.max(c).alias(f"h{c}") for c in FEATURES)).first()
    for r in made.collect():
        assert all(spans[f"l{c}"] - 1e-9 <= r[c] <= spans[f"h{c}"] + 1e-9 for c in FEATURES)
    assert sorted(smote_balance(train.repartition(3)).collect()) == sorted(rows.collect())


def test_balance_needs_two_classes_and_enough_rows(spark, train):
    with pytest.raises(ValueError, match="two classes"):
        smote_balance(train.filter("Default = 0"))
    few = train.filter("Default = 1").limit(5).union(train.filter("Default = 0"))
    with pytest.raises(ValueError, match="too few"):
        smote_balance(few)


@pytest.fixture(scope="module")
def many(spark):
    """3,000 rows in eight dimensions, with copies and a few rows far away."""
    r = np.random.default_rng(5)
    x = r.normal(size=(3_000, 8)) * np.array([100, 30, 10, 10, 5, 5, 1, 1])
    x[100:200] = x[0]
    rows = [(f"{i:05d}", *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "Id string, " + ", ".join(f"x{j} double" for j in range(8))).repartition(6)


def test_projection_orders_find_most_neighbours(many):
    columns = [f"x{j}" for j in range(8)]
    exact = {(r["Id"], r["rank"]): r["distance"] for r in nearest(many, columns).collect()}
    near = near_by_projections(many, columns).collect()
    recall = sum(r["distance"] <= exact[r["Id"], r["rank"]] + 1e-9 for r in near) / len(exact)
    print("recall", recall)
    assert recall >= 0.9 and len(near) == len(exact) and all(r["Id"] != r["neighbour"] for r in near)


def test_blocks_lose_no_neighbour(many):
    columns = [f"x{j}" for j in range(8)]
    few = many.filter("Id < '00700'")
    answers = [
        sorted(map(tuple, near_by_projections(few, columns, orders=3, window=10, block=block).collect())) for block in (11, 40, 4_096)
    ]
    assert answers[0] == answers[1] == answers[2]


def test_projections_of_little(spark):
    schema = "Id string, x double"
    assert near_by_projections(spark.createDataFrame([], schema), ["x"]).collect() == []
    two = near_by_projections(spark.createDataFrame([("a", 1.0), ("b", 1.0)], schema), ["x"]).collect()
    assert sorted(map(tuple, two)) == [("a", 1, "b", 0.0), ("b", 1, "a", 0.0)]
