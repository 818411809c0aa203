"""Training and scoring with MLlib, and with any pandas scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.draws import digest, is_odd
from riskframe.operators.features import feature_lookup
from riskframe.operators.metrics import auc
from riskframe.operators.profile import require_unique_key, union_by_name
from riskframe.operators.scale import Scaling, fit_scaling
from riskframe.spec import CREDIT, LEARNING_RATE, LEARNING_RATE_B, TableSpec

ROUNDS = 100


class RiskModel:
    """Fitted scaling and a fitted MLlib pipeline; small enough to live on the driver."""

    def __init__(self, scaling: Scaling, fitted: PipelineModel, spec: TableSpec):
        self.scaling, self.fitted, self.spec = scaling, fitted, spec

    def score(self, df: DataFrame) -> DataFrame:
        """Input columns plus ``prediction`` (class) and ``probability`` of class 1."""
        others = [c for c in df.columns if c not in self.spec.features]
        kept = [*others, *(F.col(c).alias(f"in_{c}") for c in self.spec.features)]
        scaled = self.scaling.apply(df, kept, self.spec.scaled_order)
        scored = self.fitted.transform(scaled)
        return scored.select(
            *others, *(F.col(f"in_{c}").alias(c) for c in self.spec.features),
            "prediction", vector_to_array("probability")[1].alias("probability"),
        )


def boosted_trees(
    spec: TableSpec = CREDIT, rate: float = LEARNING_RATE, rounds: int = ROUNDS, validation: str | None = None
) -> Pipeline:
    """Assemble features in scaled order and boost trees on the logistic loss."""
    trees = GBTClassifier(
        featuresCol="assembled", labelCol="target", stepSize=rate, maxIter=rounds, seed=spec.seed
    )
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    return Pipeline(stages=[
        VectorAssembler(inputCols=spec.scaled_order, outputCol="assembled", handleInvalid="error"), trees
    ])


def train(
    df: DataFrame, spec: TableSpec = CREDIT, rate: float = LEARNING_RATE, rounds: int = ROUNDS,
    validation: DataFrame | None = None, scaling: Scaling | None = None,
) -> RiskModel:
    """Fit scaling, unless given, and classifier on ``df``; rows of ``validation`` stop the boosting early."""
    scaling = scaling or fit_scaling(df, spec=spec)
    target = F.col(spec.label).cast("double").alias("target")

    def ready(rows: DataFrame, *extra: Column) -> DataFrame:
        return scaling.apply(rows, [target, *extra], spec.scaled_order)

    rows, flag = ready(df), None
    if validation is not None:
        flag = "held_out"
        rows = ready(df, F.lit(False).alias(flag)).unionByName(ready(validation, F.lit(True).alias(flag)))
    # Boosting passes over the rows some hundred times: every core gets an equal part of them.
    even = rows.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return RiskModel(scaling, boosted_trees(spec, rate, rounds, flag).fit(even), spec)


def evaluate(scored: DataFrame, label: str = CREDIT.label) -> DataFrame:
    """Area under the curve of the probability and of the hard class, as rows."""
    return auc(scored, ["probability", "prediction"], label)


def loss_by_round(model: RiskModel, df: DataFrame) -> DataFrame:
    """(round, log_loss, accuracy) of the growing ensemble on labelled rows: what it predicts after each round.

    Every row carries its margin from round to round and becomes one row per round, summed up in each task.
    """
    trees = model.fitted.stages[-1]
    shared = [(float(w), t) for w, t in zip(trees.treeWeights, trees.trees, strict=True)]
    target = F.col(model.spec.label).cast("double").alias("target")
    ready = model.fitted.stages[0].transform(model.scaling.apply(df.filter(target.isNotNull()), [target], model.spec.scaled_order))
    # Each tree predicts in the JVM; its column is dropped as soon as it is in the list.
    scored = ready.select("target", "assembled")
    for i, (_, tree) in enumerate(shared):
        scored = tree.setFeaturesCol("assembled").setPredictionCol(f"t{i}").transform(scored)
    steps = F.array(*(F.col(f"t{i}") * w for i, (w, _) in enumerate(shared)))
    margins = scored.select("target", F.posexplode(steps).alias("at", "step"), steps.alias("steps")).select(
        "target", "at", F.aggregate(F.slice("steps", 1, F.col("at") + 1), F.lit(0.0), lambda a, b: a + b).alias("margin")
    )
    sign = 2 * F.col("target") - 1
    loss = F.log1p(F.exp(-2 * sign * F.col("margin")))
    hit = ((F.col("margin") > 0).cast("double") == F.col("target")).cast("double")
    return margins.groupBy((F.col("at") + 1).alias("round")).agg(F.avg(loss).alias("log_loss"), F.avg(hit).alias("accuracy"))


def feature_importance(df: DataFrame, spec: TableSpec = CREDIT, trees: int = 100) -> DataFrame:
    """(feature, importance) of a random forest on unscaled features."""
    rows = df.select(F.col(spec.label).cast("double").alias("target"), *spec.features)
    assembled = VectorAssembler(inputCols=list(spec.features), outputCol="assembled").transform(rows)
    forest = RandomForestClassifier(featuresCol="assembled", labelCol="target", numTrees=trees, seed=spec.seed)
    weights = forest.fit(assembled).featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(
        list(zip(spec.features, weights, strict=True)), "feature string, importance double"
    )


def top_features(df: DataFrame, k: int = 4, spec: TableSpec = CREDIT, trees: int = 100) -> DataFrame:
    """The ``k`` most important features."""
    return feature_importance(df, spec, trees).orderBy(F.col("importance").desc(), "feature").limit(k)


def score_batch(
    model: RiskModel, base: DataFrame, features: DataFrame, exclude: Sequence[str] = (), spec: TableSpec = CREDIT
) -> DataFrame:
    """Look up the features of the base rows, then score."""
    return model.score(feature_lookup(base, features, spec.features, exclude, spec.key))


def score_with(
    df: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Run a pandas scorer over Arrow batches: ``keep`` columns plus a double ``prediction``."""
    keep, columns = list(keep), list(columns)
    read = list(dict.fromkeys([*keep, *columns]))
    schema = df.select(*keep).schema.add("prediction", "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[keep].assign(prediction=predict(batch[columns]))

    return df.select(*read).mapInPandas(run, schema)


def ab_route(df: DataFrame, key: str = CREDIT.key) -> DataFrame:
    """Add ``route``: model A for keys with an odd digest, B for even ones, row by row."""
    return df.withColumn("route", F.when(is_odd(digest(key)), "A").otherwise("B"))


def ab_score(df: DataFrame, model_a: RiskModel, model_b: RiskModel, spec: TableSpec = CREDIT) -> DataFrame:
    """Each row scored by the model it is routed to."""
    routed = ab_route(df, spec.key)
    a = model_a.score(routed.filter(F.col("route") == "A"))
    b = model_b.score(routed.filter(F.col("route") == "B"))
    return a.unionByName(b)


def ab_compare(models: Mapping[str, RiskModel], test: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """(variant, score, auc) of every model on the same rows."""
    out = None
    for name, model in models.items():
        rows = evaluate(model.score(test), spec.label).select(F.lit(name).alias("variant"), "score", "auc")
        out = rows if out is None else out.unionByName(rows)
    return out


def train_variants(
    df: DataFrame, rates: Mapping[str, float] | None = None, spec: TableSpec = CREDIT, rounds: int = ROUNDS,
    scaling: Scaling | None = None,
) -> dict[str, RiskModel]:
    """One model per learning rate on the same rows, scaled once and trained side by side.

    A round of boosting is a row of short jobs; those of one model fill the gaps of the other.
    """
    rates = dict(rates or {"A": LEARNING_RATE, "B": LEARNING_RATE_B})
    scaling = scaling or fit_scaling(df, spec=spec)
    fit = inheritable_thread_target(df.sparkSession)(lambda rate: train(df, spec, rate, rounds, scaling=scaling))
    with ThreadPool(max(1, len(rates))) as pool:
        return dict(zip(rates, pool.map(fit, rates.values()), strict=True))


def prediction_table(model: RiskModel, *tables: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """Key, features and ``Predicted_Default`` of all rows of the tables, whose keys must be unique."""
    rows = union_by_name(*(t.select(*spec.clean) for t in tables))
    require_unique_key(rows, spec.key)
    return model.score(rows).select(*spec.clean, F.col("prediction").alias(f"Predicted_{spec.label}"))
