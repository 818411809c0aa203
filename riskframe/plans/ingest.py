"""Incremental load of source rows into train, test and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.features import (
    absent_from, changed_rows, feature_insert, new_rows, newest_rows,
)
from riskframe.operators.split import split_bernoulli
from riskframe.sources.scan import conform, scan_table
from riskframe.sources.tables import append_table, finish_rewrite, overwrite_table, quoted, rewrite_table
from riskframe.spec import CREDIT, TableSpec


def incoming(source: DataFrame, train: DataFrame, test: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """New source rows with the split they go to."""
    return split_bernoulli(new_rows(source, train, test, spec), key=spec.key, seed=spec.seed)


def feature_rows(
    source: DataFrame, train: DataFrame, test: DataFrame, mark: DataFrame | Column, spec: TableSpec = CREDIT
) -> DataFrame:
    """What the feature table gains after a load into train and test that began at ``mark``."""
    return feature_insert(source, train, test, mark, spec)


def upsert_features(spark: SparkSession, batch: DataFrame, features: str, spec: TableSpec = CREDIT) -> int:
    """Bring the newest version of every key of the batch into the feature table; returns new and changed rows.

    Without new versions of known keys it is an append. Otherwise the table is staged and replaced, as plain tables
    have no row updates; a replacement that died is finished first.
    """
    finish_rewrite(spark, features)
    table = scan_table(spark, features)
    newest = conform(newest_rows(batch.select(*spec.clean, spec.updated_at), spec.key, spec.updated_at), table.schema)
    changed = changed_rows(newest, table)
    known = changed.join(table.select(spec.key), spec.key, "left_semi")
    if known.isEmpty():
        return append_table(changed, features)
    added = changed.count()
    rewrite_table(table.join(changed.select(spec.key), spec.key, "left_anti").unionByName(changed), features)
    return added


def ingest(
    spark: SparkSession, source: str, train: str, test: str, features: str, spec: TableSpec = CREDIT
) -> dict[str, int]:
    """Load new rows; returns inserted rows per table.

    Features of known keys are replaced by their newest version. The batch is stored first in a pending table and
    every write skips rows that are already there.
    A run that dies half-way is finished by the next one, and a finished run repeated adds nothing.
    """
    pending = f"{train}__pending"
    if not spark.catalog.tableExists(quoted(pending)):
        batch = incoming(scan_table(spark, source), scan_table(spark, train), scan_table(spark, test), spec)
        overwrite_table(batch, pending)
    batch = scan_table(spark, pending)
    added = {features: upsert_features(spark, batch, features, spec)}
    oldest = batch.agg(F.min(spec.updated_at)).scalar()  # rows already there cannot be older
    for part, name in (("train", train), ("test", test)):
        rows = batch.filter(F.col("split") == part).drop("split")
        there = scan_table(spark, name).filter(F.col(spec.updated_at) >= oldest)
        added[name] = append_table(absent_from(rows, there, [spec.key, spec.updated_at]), name)
    spark.sql(f"DROP TABLE {quoted(pending)}")
    return added


def insert_inference_rows(spark: SparkSession, rows: DataFrame, features: str, spec: TableSpec = CREDIT) -> int:
    """Add inference rows to the feature table once per key, however often it is called."""
    return append_table(absent_from(rows.select(*spec.clean), scan_table(spark, features), [spec.key]), features)
