import hashlib
from datetime import datetime
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics, models, synth
from riskframe.operators.scale import fit_scaling
from riskframe.plans import compare
from riskframe.schemas import feature_table_schema
from riskframe.sources import scan
from riskframe.spec import CREDIT, DRIFT_COLUMNS, FEATURES


@pytest.fixture(scope="module")
def pair(train):
    return models.train_variants(train, {"A": 0.05, "B": 0.1}, rounds=3)


def test_training_learns_and_scores_every_row(credit_rows, pair):
    scored = pair["A"].score(credit_rows)
    assert scored.count() == credit_rows.count()
    assert scored.filter("probability < 0 or probability > 1 or prediction not in (0, 1)").isEmpty()
    areas = {r["score"]: r["auc"] for r in models.evaluate(scored).collect()}
    assert areas["probability"] > 0.6
    kept = scored.select(credit_rows.columns)
    assert kept.exceptAll(credit_rows).isEmpty()


def test_variants_are_scaled_once_and_trained_side_by_side(train, monkeypatch):
    fitted, both, plain = [], Barrier(2, timeout=60), models.train
    monkeypatch.setattr(models, "fit_scaling", lambda *a, **k: fitted.append(1) or fit_scaling(*a, **k))
    monkeypatch.setattr(models, "train", lambda *a, **k: both.wait() is not None and plain(*a, **k))
    made = models.train_variants(train, {"A": 0.05, "B": 0.1}, rounds=1)
    assert len(fitted) == 1 and list(made) == ["A", "B"]
    assert [m.fitted.stages[-1].getStepSize() for m in made.values()] == [0.05, 0.1]


def test_rows_to_boost_fill_all_cores(spark, train, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "boosted_trees", lambda *a: type("Fit", (), {"fit": lambda self, rows: seen.append(rows)})())
    models.train(train.coalesce(1), scaling=fit_scaling(train))
    assert seen[0].rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and seen[0].count() == train.count()


def test_routing_is_the_parity_of_the_digest(test_rows, pair):
    routed = models.ab_score(test_rows, pair["A"], pair["B"])
    assert routed.count() == test_rows.count()
    single = {n: {r["Id"]: r["probability"] for r in m.score(test_rows).collect()} for n, m in pair.items()}
    for r in routed.collect():
        want = "A" if int(hashlib.md5(r["Id"].encode()).hexdigest(), 16) % 2 else "B"
        assert r["route"] == want and r["probability"] == single[want][r["Id"]]


def test_batch_scoring_looks_features_up(test_rows, pair):
    store = scan.conform(test_rows, feature_table_schema())
    a = models.score_batch(pair["A"], test_rows.select("Id"), store).select("Id", "probability")
    b = pair["A"].score(test_rows).select("Id", "probability")
    assert sorted(a.collect()) == sorted(b.collect())
    decision = compare.compare(pair["B"], pair["B"], test_rows, store).first()
    assert decision["promote"] is False and decision["auc_new"] == decision["auc_old"]


def test_prediction_table_and_python_scorer(train, test_rows, pair):
    rows = models.prediction_table(pair["A"], train, test_rows)
    assert rows.columns == [*CREDIT.clean, "Predicted_Default"]
    assert rows.count() == train.count() + test_rows.count()
    with pytest.raises(ValueError, match="primary key"):
        models.prediction_table(pair["A"], train, train)
    doubled = models.score_with(test_rows, lambda b: b["Age"] * 2.0, ["Age"], ["Id", "Age"])
    assert doubled.filter("prediction <> Age * 2").isEmpty()


def test_importance_finds_the_driver(train):
    told = train.withColumn("Default", (F.col("Age") > 50).cast("int"))
    top = models.top_features(told, trees=10).collect()
    assert len(top) == 4 and top[0]["feature"] == "Age"


def test_whole_local_training(credit_rows):
    _, areas, reports = compare.train_and_evaluate(credit_rows, rounds=2)
    assert {r["split"] for r in areas.collect()} == {"val", "test"}
    assert reports.filter("class = 'accuracy'").count() == 2


def test_synthetic_rows(train):
    made = synth.synthesize(train, 300, as_of=datetime(2024, 1, 1))
    assert made.columns == ["Id", *[c for c in train.columns if c != "Id"]]
    assert made.schema["Update_timestamp_utc"] == train.schema["Update_timestamp_utc"]
    top = train.agg(F.max(F.col("Id").cast("int"))).first()[0]
    rows = made.collect()
    assert sorted(int(r["Id"]) for r in rows) == list(range(top + 1, top + 301))
    for c in ("Sex", "Education", "Marriage", "Default"):
        assert {r[c] for r in rows} == {r[0] for r in train.select(c).distinct().collect()}
    assert all(r["Pay_amt1"] >= 0 and r["Pay_amt1"] == int(r["Pay_amt1"]) for r in rows)
    newest = train.agg(F.max("Update_timestamp_utc")).first()[0]
    assert all(newest <= r["Update_timestamp_utc"] < datetime(2024, 1, 1) for r in rows)
    again = synth.synthesize(train.repartition(5), 300, as_of=datetime(2024, 1, 1)).repartition(3)
    assert sorted(again.collect()) == sorted(rows)

    skewed = synth.synthesize(train, 300, drift=True, as_of=datetime(2024, 1, 1)).collect()
    by_id = {r["Id"]: r for r in rows}
    assert all(r[c] == by_id[r["Id"]][c] * 1.5 for r in skewed for c in DRIFT_COLUMNS)
    assert all(r[c] == by_id[r["Id"]][c] for r in skewed for c in FEATURES if c not in DRIFT_COLUMNS)
    other = synth.synthesize(train, 300, seed=1, as_of=datetime(2024, 1, 1)).collect()
    assert {r["Age"] for r in other} != {r["Age"] for r in rows}


def test_future_times_and_nulls_in_synthetic_rows(spark):
    df = spark.createDataFrame([("1", 1, datetime(2030, 1, 1), "x"), ("2", None, datetime(2031, 1, 1), "y")],
                               "Id string, n int, t timestamp, word string")
    rows = synth.synthesize(df, 50, as_of=datetime(2024, 1, 1)).collect()
    assert {r["n"] for r in rows} == {1, None}
    assert {r["t"] for r in rows} == {datetime(2031, 1, 1)}
    assert "word" not in rows[0].asDict()


def test_losses_by_round_are_those_of_the_ensemble(train, test_rows, pair):
    """The last round is the whole model; losses of the training rows fall."""
    rounds = {r["round"]: r for r in models.loss_by_round(pair["B"], test_rows).collect()}
    assert sorted(rounds) == [1, 2, 3]
    scored = pair["B"].score(test_rows)
    whole = metrics.log_loss(scored, "Default", "probability").first()["log_loss"]
    assert rounds[3]["log_loss"] == pytest.approx(whole, abs=1e-9)
    right = scored.filter(F.col("prediction") == F.col("Default")).count() / scored.count()
    assert rounds[3]["accuracy"] == pytest.approx(right)
    own = [r["log_loss"] for r in models.loss_by_round(pair["B"], train).orderBy("round").collect()]
    assert own[0] > own[1] > own[2]


def test_training_report(train):
    rows = compare.training_report(train, rounds=3).collect()
    losses = {r["round"]: r["value"] for r in rows if r["kind"] == "log_loss"}
    assert sorted(losses) == [1, 2, 3] and all(0.5 < v < 0.8 for v in losses.values())  # few rows
    cells = {(r["label"], r["prediction"]): r["value"] for r in rows if r["kind"] == "confusion"}
    assert set(cells) <= {(a, b) for a in (0.0, 1.0) for b in (0.0, 1.0)} and sum(cells.values()) > 0
    assert all(0 <= r["value"] <= 1 for r in rows if r["kind"] == "accuracy")
