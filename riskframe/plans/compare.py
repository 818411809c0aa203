"""Local training with evaluation, and the promotion decision between two models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.metrics import champion_challenger, classification_report, confusion_matrix, score_join
from riskframe.operators.models import ROUNDS, RiskModel, evaluate, loss_by_round, score_batch, train
from riskframe.operators.scale import fit_scaling
from riskframe.operators.balance import smote_balance
from riskframe.operators.split import split_stratified
from riskframe.session import cut_lineage
from riskframe.spec import CREDIT, TableSpec


def train_and_evaluate(
    df: DataFrame, spec: TableSpec = CREDIT, rounds: int = ROUNDS, balance: bool = True
) -> tuple[RiskModel, DataFrame, DataFrame]:
    """Stratified split, scaling, balancing, training: model, areas and report rows of val and test."""
    rows = split_stratified(df, spec.label, spec.key, spec.seed)
    fit_on = rows.filter(F.col("split") == "train")
    scaling = fit_scaling(fit_on, spec=spec)
    if balance:
        # Neighbours are searched on scaled values; training scales again, so interpolate there and undo it.
        scaled = scaling.apply(fit_on, [spec.key, spec.label], spec.scaled_order)
        grown = smote_balance(scaled, spec.features, seed=spec.seed, spec=spec)
        undo = {c: F.col(c) * scaling.width[c] + scaling.centre[c] for c in scaling.centre}
        fit_on = grown.withColumns(undo)
    model = train(fit_on, spec, rounds=rounds, scaling=scaling)
    areas, reports = None, None
    for part in ("val", "test"):
        scored = model.score(rows.filter(F.col("split") == part).drop("split"))
        area = evaluate(scored, spec.label).select(F.lit(part).alias("split"), "score", "auc")
        report = classification_report(scored, spec.label).select(F.lit(part).alias("split"), "*")
        areas = area if areas is None else areas.unionByName(area)
        reports = report if reports is None else reports.unionByName(report)
    return model, areas, reports


def training_report(df: DataFrame, spec: TableSpec = CREDIT, rounds: int = 20) -> DataFrame:
    """(kind, round, label, prediction, value) of a local training on a stratified split, without balancing.

    ``log_loss`` and ``accuracy`` of the validation rows after every round, and the confusion counts of the test rows.
    """
    rows = cut_lineage(split_stratified(df, spec.label, spec.key, spec.seed))
    of = {p: rows.filter(F.col("split") == p).drop("split") for p in ("train", "val", "test")}
    model = train(of["train"], spec, rounds=rounds)
    null = F.lit(None).cast("double")
    losses = loss_by_round(model, of["val"]).select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("kind"), F.col("round"), null.alias("label"), null.alias("prediction"), F.col(c).alias("value"))
                           for c in ("log_loss", "accuracy"))))
    )
    counts = confusion_matrix(model.score(of["test"]), spec.label).select(
        F.lit("confusion").alias("kind"), F.lit(None).cast("int").alias("round"), "label", "prediction", F.col("rows").cast("double").alias("value")
    )
    return losses.unionByName(counts)


def compare(new: RiskModel, old: RiskModel, test: DataFrame, features: DataFrame, spec: TableSpec = CREDIT):
    """One row saying whether the new model replaces the old one on the test set."""
    base = test.select(spec.key, spec.label)
    scores = [
        score_batch(m, base.select(spec.key), features, spec=spec)
        .select(spec.key, F.col("probability").alias("prediction"))
        for m in (new, old)
    ]
    return champion_challenger(score_join(base, *scores, key=spec.key, label=spec.label), spec.label)
