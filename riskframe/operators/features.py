"""Keyed feature tables: lookup, incremental loads, change feeds, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ranking import hash_ranked
from riskframe.spec import CREDIT, SEED, TableSpec


def high_water_mark(*tables: DataFrame, column: str = CREDIT.updated_at) -> DataFrame:
    """One row with the latest time in any of the tables; null when all are empty."""
    tops = [t.agg(F.max(column).alias("top")) for t in tables]
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return out.agg(F.max("top").alias("high_water_mark"))


def later_than(mark: DataFrame | Column, column: str = CREDIT.updated_at) -> Column:
    """Strictly after the mark; everything when there is no mark yet."""
    mark = mark.scalar() if isinstance(mark, DataFrame) else mark
    return mark.isNull() | (F.col(column) > mark)


def new_rows(source: DataFrame, train: DataFrame, test: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """Source rows newer than anything loaded. The mark is a scalar subquery of the same plan."""
    mark = high_water_mark(train, test, column=spec.updated_at)
    return source.filter(later_than(mark, spec.updated_at))


def feature_insert(
    source: DataFrame, train: DataFrame, test: DataFrame, mark: DataFrame | Column, spec: TableSpec = CREDIT
) -> DataFrame:
    """Distinct clean columns of new source rows whose key was newly loaded into train or test."""
    newer = later_than(mark, spec.updated_at)
    loaded = train.select(spec.key, spec.updated_at).unionByName(test.select(spec.key, spec.updated_at))
    keys = loaded.filter(newer).select(spec.key).distinct()
    return source.filter(newer).join(keys, spec.key, "left_semi").select(*spec.clean).distinct()


def insert_delta(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Row accounting of an append as one row: before, after, inserted."""
    before = current.agg(F.count(F.lit(1)).alias("rows_before"))
    added = incoming.agg(F.count(F.lit(1)).alias("inserted")).scalar()
    return before.select("rows_before", (F.col("rows_before") + added).alias("rows_after"), added.alias("inserted"))


def absent_from(rows: DataFrame, target: DataFrame, keys: Sequence[str] = (CREDIT.key,)) -> DataFrame:
    """Rows whose key is not in the target yet: makes a repeated insert add nothing."""
    return rows.join(target.select(*keys).distinct(), list(keys), "left_anti")


def feature_lookup(
    base: DataFrame,
    features: DataFrame,
    names: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    key: str = CREDIT.key,
) -> DataFrame:
    """Base rows with the named features of their key; a base row without features keeps nulls."""
    names = list(names or (c for c in features.columns if c != key))
    kept = base.drop(*exclude, *(n for n in names if n in base.columns))
    return kept.join(features.select(key, *names), key, "left")


def point_lookup(features: DataFrame, keys: Sequence[str], key: str = CREDIT.key) -> DataFrame:
    """Rows of a few keys; the filter reaches the scan."""
    return features.filter(F.col(key).isin(list(keys)))


def change_feed(old: DataFrame, new: DataFrame, key: str = CREDIT.key) -> DataFrame:
    """Rows that differ between two snapshots of a keyed table, with ``_change_type``.

    Deleted rows carry their old values, inserted and updated rows the new ones.
    """
    columns = [c for c in new.columns if c != key]
    a = old.select(key, F.struct(*columns).alias("_old"))
    b = new.select(key, F.struct(*columns).alias("_new"))
    both = a.join(b, key, "full_outer")
    kind = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .otherwise("update")
    )
    changed = both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        key, kind.alias("_change_type"), F.coalesce("_new", "_old").alias("_row")
    )
    return changed.select(key, "_change_type", "_row.*")


def newest_rows(rows: DataFrame, key: str = CREDIT.key, version: str = CREDIT.updated_at) -> DataFrame:
    """One row per key: the latest version, later columns deciding ties."""
    rest = [F.col(c).desc() for c in rows.columns if c not in (key, version)]
    order = Window.partitionBy(key).orderBy(F.col(version).desc(), *rest)
    return rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") == 1).drop("_place")


def changed_rows(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows that the target does not hold with the same values; nulls equal nulls."""
    there = target.select(*(F.col(c).alias(f"_there_{c}") for c in rows.columns))
    same = F.lit(True)
    for c in rows.columns:
        same &= F.col(c).eqNullSafe(F.col(f"_there_{c}"))
    return rows.join(there, same, "left_anti")


def upsert_latest(
    current: DataFrame,
    changes: DataFrame,
    key: str = CREDIT.key,
    version: str = CREDIT.updated_at,
    deletes: str | None = None,
) -> DataFrame:
    """The table after applying changes: the latest version per key, a change winning a tie.

    The filter on ``row_number`` lets every task keep one candidate per key before the shuffle, so a
    key with very many versions costs no more than others. ``deletes`` names a boolean column of the
    changes that removes the key.
    """
    columns = current.columns
    gone = F.col(deletes) if deletes else F.lit(False)
    rows = current.withColumns({"_side": F.lit(0), "_gone": F.lit(False)}).unionByName(
        changes.select(*columns, F.lit(1).alias("_side"), gone.alias("_gone"))
    )
    rest = [F.col(c).desc() for c in columns if c not in (key, version)]
    newest = Window.partitionBy(key).orderBy(F.col(version).desc(), F.col("_side").desc(), *rest)
    latest = rows.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") == 1)
    return latest.filter(~F.col("_gone")).select(*columns)


def max_key(*tables: DataFrame, key: str = CREDIT.key) -> DataFrame:
    """Largest key read as a number, over all tables; keys that are no numbers are ignored."""
    tops = [t.agg(F.max(F.col(key).try_cast("bigint")).alias("top")) for t in tables]
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return out.agg(F.coalesce(F.max("top"), F.lit(0)).alias("top"))


def new_ids(rows: DataFrame, *existing: DataFrame, key: str = CREDIT.key, seed: int = SEED) -> DataFrame:
    """Give rows consecutive string keys after the largest key in use; the old key moves to ``source_key``."""
    placed = hash_ranked(rows.withColumnRenamed(key, "source_key"), "source_key", seed)
    top = max_key(*existing, key=key).scalar()
    rest = [c for c in rows.columns if c != key]
    return placed.select((F.col("rank") + top).cast("string").alias(key), "source_key", *rest)
