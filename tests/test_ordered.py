import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics, monitor, ordered, profile
from riskframe.operators.scale import fit_scaling


@pytest.fixture(scope="module")
def numbers(spark):
    """Smooth values, a column where one value holds a third of the rows, a constant, nulls."""
    n = F.col("id")
    return spark.range(20_000).select(
        (n % 7).alias("g"),
        ((n * 7919) % 20_011 / 7.0).alias("a"),
        F.when(n % 3 == 0, 5.0).otherwise(((n * 31) % 1009).cast("double")).alias("b"),
        F.lit(3.5).alias("c"),
        F.when(n % 4 > 0, (n % 50).cast("double")).alias("d"),
    )


def test_quantiles_match_numpy(numbers):
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["column"]: r["quantiles"] for r in
           ordered.quantiles(numbers, list("abcd"), shares).collect()}
    pdf = numbers.toPandas()
    for c in "abcd":
        np.testing.assert_allclose(got[c], pdf[c].dropna().quantile(shares), rtol=1e-12)


def test_grouped_quantiles(numbers):
    got = {(r["g"], r["column"]): (r["q25"], r["q50"], r["q75"]) for r in
           ordered.quartiles(numbers, ["a", "b"], ["g"]).collect()}
    pdf = numbers.toPandas().groupby("g")
    for c in ("a", "b"):
        for g, want in pdf[c].quantile([0.25, 0.5, 0.75]).unstack().iterrows():
            np.testing.assert_allclose(got[(g, c)], want)


def test_groups_of_nulls_are_kept(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("b", None)], "g string, x double")
    got = ordered.quartiles(df, ["x"], ["g"], {"rows": lambda v: F.count(F.lit(1))}).collect()
    assert sorted((r["g"], r["rows"], r["q50"]) for r in got) == [("a", 2, 1.0), ("b", 2, None)]
    with pytest.raises(ValueError, match="x"):
        fit_scaling(df.filter("g = 'b'"), ["x"])


def test_scaling_centres_and_width_of_constant(numbers):
    fit = fit_scaling(numbers, ["a", "c"])
    assert fit.width["c"] == 1.0 and fit.centre["c"] == 3.5
    scaled = fit.apply(numbers, [], ["a", "c"])
    q = {r["column"]: r for r in ordered.quartiles(scaled, ["a", "c"]).collect()}
    assert abs(q["a"]["q50"]) < 1e-12 and abs(q["a"]["q75"] - q["a"]["q25"] - 1) < 1e-12


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))


def test_auc_matches_all_pairs(numbers):
    df = numbers.limit(3000).withColumn("y", (F.col("a") % 2 < 0.7).cast("int"))
    got = {r["score"]: r["auc"] for r in metrics.auc(df, ["a", "b", "c"], "y").collect()}
    pdf = df.toPandas()
    for c in "abc":
        assert got[c] == pytest.approx(brute_auc(pdf["y"].to_numpy(), pdf[c].to_numpy()), abs=1e-12)
    assert got["c"] == 0.5


def test_auc_is_invariant_and_null_for_one_class(numbers):
    df = numbers.withColumn("y", (F.col("g") > 3).cast("int")).withColumn("e", F.exp(F.col("a") / 500))
    got = {r["score"]: r["auc"] for r in metrics.auc(df, ["a", "e"], "y").collect()}
    assert got["a"] == pytest.approx(got["e"], abs=1e-12)
    assert metrics.auc(df.filter("y = 1"), "a", "y").first()["auc"] is None


def test_hard_label_auc_is_balanced_accuracy(spark):
    df = spark.createDataFrame([(1, 1.0)] * 3 + [(1, 0.0)] + [(0, 0.0)] * 6 + [(0, 1.0)] * 2, "Default int, prediction double")
    assert metrics.auc(df, "prediction").first()["auc"] == pytest.approx((3 / 4 + 6 / 8) / 2)
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["1.0"]["precision"] == pytest.approx(3 / 5) and report["1.0"]["support"] == 4
    assert report["accuracy"]["f1"] == pytest.approx(9 / 12)


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "Default int, prediction double")
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["1.0"]["precision"] == 0 and report["1.0"]["f1"] == 0


def test_tie_keeps_the_champion(spark):
    rows = spark.createDataFrame([(1, 0.9, 0.8), (0, 0.1, 0.2)], "Default int, prediction_new double, prediction_old double")
    assert metrics.champion_challenger(rows).first()["promote"] is False


def test_profiles(numbers):
    p = {r["column"]: r for r in profile.column_profile(numbers, list("abcd")).collect()}
    assert p["c"]["distinct"] == 1 and p["c"]["discrete"]
    assert p["d"]["distinct"] == numbers.toPandas()["d"].nunique() + 1 and not p["d"]["discrete"]
    values = profile.unique_values(numbers, ["a", "d"]).collect()  # however many
    pdf = numbers.toPandas()
    assert sorted((r["column"], r["value"]) for r in values) == sorted((c, v) for c in "ad" for v in pdf[c].dropna().unique())


def test_repeats_of_keys_and_whole_rows(spark):
    df = spark.createDataFrame([("1", 1), ("1", 1), ("1", 2), ("2", 5), (None, 1), (None, 3)], "Id string, v int")
    assert sorted(map(tuple, profile.duplicate_rows(df).collect()), key=str) == [("1", 1), ("1", 2), (None, 3)]
    assert {r["Id"] for r in profile.pk_violations(df).collect()} == {"1", None}
    with pytest.raises(ValueError, match="primary key"):
        profile.require_unique_key(df)


def test_no_drift_without_change(numbers):
    psi = monitor.drift_psi(numbers, numbers, ["a", "b", "c"]).collect()
    assert len(psi) == 3 and all(abs(r["psi"]) < 1e-12 for r in psi)
    moved = numbers.withColumn("a", F.col("a") * 1.5)
    assert {r["column"]: r["psi"] for r in monitor.drift_psi(numbers, moved, ["a"]).collect()}["a"] > 0.1
    assert monitor.drift_ks(numbers, moved, ["a"]).first()["ks"] > 0.1


def test_ks_is_the_two_sample_statistic(numbers):
    moved = numbers.filter("id % 3 > 0" if "id" in numbers.columns else "g > 1").withColumn("a", F.col("a") * 1.1 + 3).withColumn("d", F.lit(None).cast("double"))
    got = {r["column"]: r["ks"] for r in monitor.drift_ks(numbers, moved, list("abcd")).collect()}
    old, new = numbers.toPandas(), moved.toPandas()
    for c in "abc":
        x, y = np.sort(old[c].dropna()), np.sort(new[c].dropna())
        at = np.union1d(x, y)
        want = np.abs(np.searchsorted(x, at, "right") / len(x) - np.searchsorted(y, at, "right") / len(y)).max()
        assert got[c] == pytest.approx(want, abs=1e-12)
    assert got["d"] is None


def test_quantiles_of_nothing(spark, numbers):
    none = ordered.quartiles(numbers.filter("g < 0"), ["a", "b"]).collect()
    assert sorted((r["column"], r["q50"]) for r in none) == [("a", None), ("b", None)]
    assert ordered.quartiles(numbers.filter("g < 0"), ["a"], ["g"]).collect() == []
    nulls = ordered.quartiles(numbers.withColumn("a", F.lit(None).cast("double")), ["a", "c"]).collect()
    assert {r["column"]: r["q50"] for r in nulls} == {"a": None, "c": 3.5}


def test_windows_drift_against_the_one_before(spark):
    """Two models, a gap between windows, a column that is missing in one of them."""
    at = lambda h: f"2024-01-01 {h:02d}:10:00"
    rows = [("a", at(0), float(i), 1.0) for i in range(10)] + [("a", at(5), float(i) + 5, None) for i in range(10)]
    rows += [("a", at(6), float(i) + 5, 2.0) for i in range(10)] + [("b", at(0), 3.0, 1.0)]
    df = spark.createDataFrame(rows, "model_name string, timestamp string, x double, y double").withColumn("timestamp", F.to_timestamp("timestamp"))
    got = {(r["model_name"], r["window_start"].hour, r["column"]): (r["psi"], r["mean_shift"]) for r in monitor.window_drift(df, ["x", "y"], "1 hour").collect()}
    assert set(got) == {("a", 5, "x"), ("a", 6, "x")}
    assert got["a", 5, "x"][1] == pytest.approx(5.0) and got["a", 5, "x"][0] > 1
    assert got["a", 6, "x"] == (pytest.approx(0.0), pytest.approx(0.0))
