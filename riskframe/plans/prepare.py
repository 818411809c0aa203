"""Raw extract to train and test sets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.balance import smote_balance
from riskframe.operators.clean import clean, require_clean, require_columns, require_numeric
from riskframe.operators.features import feature_lookup
from riskframe.operators.split import split_exact, stamp
from riskframe.sources.scan import scan_csv
from riskframe.sources.tables import create_keyed_table, overwrite_table
from riskframe.spec import CREDIT, SEED, TableSpec


def prepared(raw: DataFrame, as_of: datetime | None = None, spec: TableSpec = CREDIT) -> DataFrame:
    """Cleaned rows with their split and ingest time, as one lazy plan."""
    return stamp(split_exact(clean(raw, spec), key=spec.key, seed=spec.seed), as_of, spec)


def prepare_tables(
    spark: SparkSession, csv_path: str, train: str, test: str, as_of: datetime | None = None, spec: TableSpec = CREDIT
) -> None:
    """Read the extract, gate it, and write both sets."""
    raw = require_numeric(require_columns(scan_csv(spark, csv_path), [spec.raw_target]), spec.raw_target)
    require_clean(clean(raw, spec), spec)
    rows = prepared(raw, as_of or datetime.now(), spec)
    for part, name in (("train", train), ("test", test)):
        overwrite_table(rows.filter(F.col("split") == part).drop("split"), name)


def feature_table(train: DataFrame, spec: TableSpec = CREDIT, seed: int = SEED, start_id: int | None = None):
    """The balanced feature table: key and double features, no label."""
    return smote_balance(train, spec.features, seed=seed, start_id=start_id, spec=spec).select(*spec.clean)


def write_feature_table(train: DataFrame, name: str, spec: TableSpec = CREDIT) -> None:
    create_keyed_table(feature_table(train, spec), name, spec.key)


def training_set(train: DataFrame, features: DataFrame, names: Sequence[str] | None = None, spec: TableSpec = CREDIT):
    """Key, looked-up features and label of the train rows; synthetic rows have no label and stay out."""
    base = train.select(spec.key, spec.label)
    return feature_lookup(base, features, names or spec.features, key=spec.key)
