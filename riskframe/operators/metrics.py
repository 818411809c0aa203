"""Classifier metrics as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.ratios import count_where, long_form, ratio
from riskframe.operators.positions import running
from riskframe.spec import CREDIT

WHOLE = "decimal(18,0)"


def auc(df: DataFrame, scores: Sequence[str] | str, label: str = CREDIT.label) -> DataFrame:
    """Exact tie-aware area under the ROC curve per score column: (score, positives, negatives, auc).

    Rows collapse to distinct scores first; each distinct score then needs the number of negatives below it, a running sum
    over key ranges. Counts stay integers up to the last division. With one class only, ``auc`` is null. Hard 0/1
    predictions are scores like any other.
    """
    scores = [scores] if isinstance(scores, str) else list(scores)
    tied = df.filter(F.col(label).isNotNull()).select(*long_form(scores, label)).filter(F.col("value").isNotNull())
    counted = tied.groupBy("column", "value").agg(
        count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) != 1).alias("neg")
    )
    lower = F.col("neg_upto") - F.col("neg")
    pairs = F.col("pos").cast(WHOLE) * (2 * lower + F.col("neg")).cast(WHOLE)
    summed = running(counted, ["column"], "value", ["neg"]).groupBy(F.col("column").alias("score")).agg(
        F.sum(pairs).alias("pairs"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    possible = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return summed.select(
        "score", "positives", "negatives", F.try_divide(F.col("pairs").cast("double"), possible).alias("auc")
    )


def confusion_matrix(df: DataFrame, label: str = CREDIT.label, prediction: str = "prediction") -> DataFrame:
    """Row counts per (label, prediction)."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_report(df: DataFrame, label: str = CREDIT.label, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Works on the confusion counts, one row per pair of classes; empty denominators give 0. For the
    accuracy row the three ratios all hold the accuracy.
    """
    cells = confusion_matrix(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)
    sides = cells.select(
        F.inline(F.array(
            F.struct(F.col("label").alias("class"), F.col("rows").alias("support"),
                     F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("hits")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                     F.col("rows").alias("predicted"), F.lit(0).cast("long").alias("hits")),
        ))
    )
    classes = sides.groupBy("class").agg(*(F.sum(c).alias(c) for c in ["support", "predicted", "hits"]))
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    per_class = classes.select(
        F.col("class").cast("string").alias("class"), precision.alias("precision"), recall.alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"), "support", "hits",
    )

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    means = per_class.agg(
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *(F.avg(c).alias(f"macro_{c}") for c in ["precision", "recall", "f1"]),
        *(weighted(c).alias(f"weighted_{c}") for c in ["precision", "recall", "f1"]),
        F.sum("support").alias("support"),
    )

    def line(name: str, p: str, r: str, f: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"),
            F.col(f).alias("f1"), F.col("support"),
        )

    summary = means.select(F.inline(F.array(
        line("accuracy", "accuracy", "accuracy", "accuracy"),
        line("macro avg", "macro_precision", "macro_recall", "macro_f1"),
        line("weighted avg", "weighted_precision", "weighted_recall", "weighted_f1"),
    )))
    return per_class.drop("hits").unionByName(summary)


def log_loss(df: DataFrame, label: str, probability: str, clip: float = 1e-15) -> DataFrame:
    """Mean negative log-likelihood with probabilities kept away from 0 and 1."""
    y = F.col(label).cast("double")
    p = F.least(F.greatest(F.col(probability), F.lit(clip)), F.lit(1 - clip))
    loss = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg(F.count(loss).alias("rows"), F.avg(loss).alias("log_loss"))


def score_join(labels: DataFrame, new: DataFrame, old: DataFrame, key: str = CREDIT.key, label: str = CREDIT.label):
    """Label with both models' predictions; only key and prediction columns take part in the joins."""
    return (
        labels.select(key, label)
        .join(new.select(key, F.col("prediction").alias("prediction_new")), key)
        .join(old.select(key, F.col("prediction").alias("prediction_old")), key)
    )


def champion_challenger(joined: DataFrame, label: str = CREDIT.label) -> DataFrame:
    """One row: both areas and whether the new model replaces the old one; a tie keeps the old one."""
    areas = auc(joined, ["prediction_new", "prediction_old"], label)
    both = areas.agg(
        F.max(F.when(F.col("score") == "prediction_new", F.col("auc"))).alias("auc_new"),
        F.max(F.when(F.col("score") == "prediction_old", F.col("auc"))).alias("auc_old"),
    )
    return both.withColumn("promote", F.coalesce(F.col("auc_old") < F.col("auc_new"), F.lit(False)))
