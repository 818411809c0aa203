"""Whitening and hard negatives against brute force on small tables with nulls, ties, repeated and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import duck, rows_of
from riskframe.llm import negatives, whitening
from riskframe.llm.oracles import ORACLES

SCHEMA = "vec_id long, embedding array<float>, label int, x long, n string, row long, piece string"
NAN, INF = float("nan"), float("inf")


def vectors(seed=0, n=300, width=6, copies=120):
    """Gaussian vectors around a few centres, a third of them one vector, some repeated in id or wholly, and rows that take no part."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, width))
    rows = [(i, (centres[i % 4] + r.normal(size=width) * 0.3).astype(np.float32).tolist(), int(r.integers(0, 4))) for i in range(n)]
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(copies)]
    rows += [rows[0], rows[0], (100, rows[5][1], 1), (100, rows[6][1], 1)]
    rows += [(2000, None, 1), (2100, [NAN] * width, 1), (2200, [INF] + [0.0] * (width - 1), 1), (2300, [None] + [0.0] * (width - 1), 1)]
    return [(*x, 5, "clash", None, None) for x in rows]


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.createDataFrame(vectors(), SCHEMA).repartition(5)


def usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def brute_whitening(rows, k, once=False):
    rows = usable(rows)
    width = max(len(r[1]) for r in rows)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in [*r[1], *[0.0] * (width - len(r[1]))]] for r in rows], np.int64)
    fit = np.unique(x, axis=0) if once else x
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    v = c.T @ c / n
    e, w = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    order = order[e[order] > 1e-9 * e.max()]
    z = ((n * x - s) / n) @ w[:, order] / np.sqrt(e[order])
    return [r[0] for r in rows], z, ((n * x - s) ** 2).sum(1), e[order] / np.trace(v), n


def same_whitening(df, rows, k, once=False, weights="count"):
    ids, z, deviation, explained, n = brute_whitening(rows, k, once)
    got, fitted, error = whitening.whiten(df, k, weights)
    got = got.collect()
    assert fitted.n == n and error < 1e-9 and len(got) == len(ids)
    assert np.allclose(fitted.explained, explained)
    ours = {}
    for r in got:
        ours.setdefault((r["vec_id"], int(r["deviation"])), []).append(r["whitened"])
    theirs = {}
    for i, d, v in zip(ids, deviation, z, strict=True):
        theirs.setdefault((i, int(d)), []).append(v)
    assert {k: len(v) for k, v in ours.items()} == {k: len(v) for k, v in theirs.items()}
    a = np.array([v for k in sorted(ours) for v in ours[k]])
    b = np.array([v for k in sorted(theirs) for v in theirs[k]])
    signs = np.sign((a * b).sum(0))  # one sign per component for all rows
    assert np.allclose(a * signs, b, atol=1e-8)


@pytest.mark.parametrize("k", [32, 3])
def test_whitening_equals_brute_force(embeddings, k):
    same_whitening(embeddings, vectors(), k)


def test_whitening_of_every_vector_once(embeddings):
    same_whitening(embeddings, vectors(), 4, once=True, weights="one")


def test_whitening_of_short_vectors_and_constant_entries(spark):
    rows = [(i, [float(i % 3), 1.5, float(i * i % 7)][: 3 if i % 2 else 2], 0, 1, "", 1, "") for i in range(40)] + [(99, [], 0, 1, "", 1, "")]
    same_whitening(spark.createDataFrame(rows, SCHEMA), rows, 32)


def test_component_rows(embeddings):
    rows = whitening.component_rows(embeddings).collect()
    ids, _, deviation, explained, n = brute_whitening(vectors(), 32)
    assert len(rows) == len(ids) * len(explained) and {r["n"] for r in rows} == {n}
    assert sorted((r["vec_id"], r["deviation"]) for r in rows if r["component"] == 1) == sorted(zip(ids, map(int, deviation), strict=True))
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-4


def test_whitening_without_variance_is_empty(spark):
    for rows in ([], [(1, [1.0, 2.0], 0, 1, "", 1, "")] * 3, [(1, [], 0, 1, "", 1, "")], [(1, None, 0, 1, "", 1, "")]):
        assert whitening.component_rows(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_exact_sums_beyond_64_bits():
    x = np.array([[2**40, -(2**40)], [2**41, 5]])
    n, totals = 2**30, np.array([7, 9])
    d = whitening.shifted(x, n, totals)
    assert d.tolist() == [[n * int(a) - int(t) for a, t in zip(r, totals, strict=True)] for r in x]
    assert whitening.squares(d) == [sum(v * v for v in r) for r in d.tolist()]


def test_hot_vectors_are_split(spark, embeddings):
    rows, fitted, _ = whitening.whiten(embeddings, 2)
    plan = whitening.joined_back(
        whitening.packed_vectors(embeddings, ["vec_id"], 64, 0), spark.createDataFrame([(b"", 1, 1, None, [0.0])], "x binary, times long, weight long, deviation decimal(38,0), whitened array<double>")
    )
    assert "h_pieces" in plan._jdf.queryExecution().analyzed().toString()
    assert rows.count() == len(usable(vectors()))


# --- hard negatives -----------------------------------------------------------------------------


def sql_rows(con):
    got = con.execute(ORACLES["op12_hard_negatives"])
    return rows_of([c[0] for c in got.description], got.fetchall())


def relabelled(df):
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return df.withColumn("label", other)


@pytest.mark.parametrize(("block_rows", "group"), [(1024, 512), (16, 2)])
def test_negatives_equal_sql(spark, embeddings, tmp_path, block_rows, group):
    extra = [(300, [0.5] * 6, None, 1, "", 1, ""), (None, [0.5] * 6, 1, 1, "", 1, ""), (-100, [0.25] * 4, 2, 1, "", 1, ""), (200, [], 1, 1, "", 1, "")]
    rows = embeddings.unionByName(spark.createDataFrame(extra, SCHEMA))
    path = str(tmp_path / "e")
    # DuckDB's inner product wants equal lengths.
    rows.withColumn("embedding", F.when(F.size("embedding") < 6, F.concat("embedding", F.array_repeat(F.lit(0.0).cast("float"), 6 - F.size("embedding")))).otherwise(F.col("embedding"))).coalesce(1).write.parquet(path)
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    found = negatives.hard_negatives(relabelled(rows), block_rows=block_rows, group=group)
    ours = rows_of(found.columns, found.collect())
    assert ours == sql_rows(con) and len(ours) > 50


def test_negatives_of_little(spark):
    for rows in ([], [(100, [1.0], 1, 1, "", 1, "")], [(1, [1.0], 1, 1, "", 1, ""), (2, [1.0], 2, 1, "", 1, "")], [(100, None, 1, 1, "", 1, "")]):
        assert negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_tree_is_least_and_bounds_hold():
    r = np.random.default_rng(1)
    m = r.integers(-50, 50, size=(40, 5))
    tree = negatives.spanning_tree(m)
    assert sorted(n for n, _, _ in tree) == list(range(40)) and tree[0][1] == -1
    seen = set()
    for node, parent, edge in tree:
        assert parent == -1 or parent in seen
        if parent >= 0:
            assert edge >= math.sqrt(((m[node] - m[parent]) ** 2).sum())
        seen.add(node)
    c = negatives.Candidates(np.arange(200), np.arange(200), np.zeros(200, int), r.integers(-90, 90, size=(200, 5)))
    scores, asked = m @ c.m.T, 0

    def wanted(i, low, high):
        assert (low <= scores[i]).all() and (high >= scores[i]).all()
        return (high >= 5000) & (low <= 6000)

    for i, at, found in negatives.walk(m, c, wanted):
        assert (found == scores[i, at]).all()
        assert set(np.flatnonzero((scores[i] >= 5000) & (scores[i] <= 6000))) <= set(at)
        asked += len(at)
    assert asked < scores.size


def test_bounds_spare_work_on_clusters(spark):
    """Far clusters are neither shipped nor scored."""
    r = np.random.default_rng(2)
    centres = np.eye(8) * 20
    rows = [(i, (centres[i % 8] + r.normal(size=8) * 0.01).tolist(), i % 8 if i % 3 else (i + 1) % 8, 1, "", 1, "") for i in range(1600)]
    df = spark.createDataFrame(rows, SCHEMA)
    packed = negatives.packed_vectors(df, ["vec_id", "label"], 256).select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("long").alias("label"), "x")
    vectors_ = negatives.stored(packed, "t")
    blocks, pivots = negatives.packed_blocks(vectors_, 8, 1600, 10, 5, 25)
    anchors = negatives.grouped_anchors(blocks, pivots, 160, 10, 20)
    seeded = anchors.withColumn("least", F.lit(256 * 256 * 390.0)).withColumn("most", F.lit(math.inf))
    pairs = negatives.open_pairs(seeded, blocks, 8).count()
    every = anchors.select("g").distinct().count() * blocks.count()
    assert pairs < every / 2
