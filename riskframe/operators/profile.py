"""Column and key profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.ratios import count_where, long_form
from riskframe.spec import CREDIT

DISCRETE_AT_MOST = 10


def numeric_columns(df: DataFrame, *skip: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, nulls, mean, sample deviation, min, max, from one pass without a row expansion."""
    aggregates = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        aggregates += [
            count_where(v.isNull()).alias(f"nulls{i}"), F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    cells = [
        F.struct(F.lit(c).alias("column"), F.col("rows"),
                 *(F.col(f"{n}{i}").alias(n) for n in ["nulls", "mean", "std", "min", "max"]))
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*cells)))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) once per distinct non-null value, with its row count; collapsed before the shuffle."""
    long = df.select(*long_form(list(columns))).filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``moments`` plus the exact distinct count, null counted as a value, and whether that is discrete."""
    columns = list(columns or numeric_columns(df))
    # Counting partial groups by (column, value) first keeps a frequent value or column from loading one task.
    distinct = distinct_values(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("values"))
    profile = moments(df, columns).join(F.broadcast(distinct), "column", "left")  # one row per column
    n = F.coalesce(F.col("values"), F.lit(0)) + F.when(F.col("nulls") > 0, 1).otherwise(0)
    return profile.withColumn("distinct", n).withColumn("discrete", n <= DISCRETE_AT_MOST).drop("values")


def unique_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) once per distinct non-null value, however many there are."""
    return distinct_values(df, columns).select("column", "value")


def row_counts(**tables: DataFrame) -> DataFrame:
    """(table, rows), one counting branch per table in a single plan."""
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
               for n, df in tables.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.union(c)
    return out


def id_set(*tables: DataFrame, key: str = CREDIT.key) -> DataFrame:
    """Distinct keys of all tables together."""
    out = tables[0].select(key)
    for t in tables[1:]:
        out = out.union(t.select(key))
    return out.distinct()


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name, duplicates kept."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def pk_violations(df: DataFrame, key: str = CREDIT.key) -> DataFrame:
    """Keys that are null or occur more than once, with their counts."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter((F.col("rows") > 1) | F.col(key).isNull())


def require_unique_key(df: DataFrame, key: str = CREDIT.key) -> DataFrame:
    bad = pk_violations(df, key).limit(5).collect()
    if bad:
        raise ValueError(f"{key} is not a primary key, e.g. {[r[key] for r in bad]}")
    return df


def duplicate_rows(df: DataFrame, key: str = CREDIT.key, order: Sequence[str] = ()) -> DataFrame:
    """Second and later occurrences of a key, in the order of the other columns or of ``order``.

    The first row per key is a minimum, found with partial aggregation; all other rows of the key are
    repeats, so nothing is ranked inside a hot key.
    """
    columns = df.columns
    order = list(order) or [c for c in columns if c != key]
    first = (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct(*order)).alias("_first"))
        .filter(F.col("_rows") > 1)
    )
    repeated = df.join(first, F.col(key).eqNullSafe(F.col("_key"))).select(*columns, "_first")
    later = repeated.filter(F.struct(*order) != F.col("_first"))
    # Copies equal in every order column: all but one of them are repeats too.
    same = repeated.filter(F.struct(*order) == F.col("_first")).groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    copies = same.filter(F.col("_rows") > 1).withColumn("_copy", F.explode(F.sequence(F.lit(2), F.col("_rows"))))
    return later.select(*columns).unionByName(copies.select(*columns))
