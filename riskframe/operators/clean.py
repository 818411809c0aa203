"""Names, types, code corrections and data-quality gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.ratios import count_where
from riskframe.spec import CREDIT, DRIFT_COLUMNS, DRIFT_FACTOR, TableSpec


class QualityError(ValueError):
    """A gate found data that must not go further."""


def rename_capitalize(df: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """Short target name, capitalised column names, string key."""
    named = df.withColumnRenamed(spec.raw_target, spec.label)
    named = named.toDF(*(c.capitalize() for c in named.columns))
    return named.withColumn(spec.key, F.col(spec.key).cast("string"))


def correct_values(df: DataFrame, corrections: Mapping[str, Mapping[int, int]] | None = None) -> DataFrame:
    """Replace codes in all columns whose name starts with a prefix; other values stay."""
    for prefix, mapping in (CREDIT.corrections if corrections is None else corrections).items():
        columns = [c for c in df.columns if c.startswith(prefix)]
        if columns:
            df = df.replace(dict(mapping), subset=columns)
    return df


def clean(df: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """The cleaning chain, lazily; ``require_clean`` is its gate."""
    return correct_values(rename_capitalize(df, spec), spec.corrections)


def ints_to_double(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast the listed columns, by default every integer column, to double."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def inject_drift(df: DataFrame, columns: Sequence[str] = tuple(DRIFT_COLUMNS), factor: float = DRIFT_FACTOR):
    """Scale those of the listed columns that exist."""
    return df.withColumns({c: F.col(c) * factor for c in columns if c in df.columns})


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required names that are absent, in the order asked."""
    return [c for c in required if c not in df.columns]


def missing_columns_report(spark: SparkSession, df: DataFrame, required: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in missing_columns(df, required)], "missing string")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    if absent := missing_columns(df, required):
        raise QualityError("missing required columns: " + ", ".join(absent))
    return df


def require_numeric(df: DataFrame, column: str) -> DataFrame:
    if not isinstance(df.schema[column].dataType, T.NumericType):
        raise QualityError(f"column '{column}' must be numeric")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise QualityError("no rows")
    return df


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: row count and null count, from one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(count_where(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)),
    )
    cells = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*cells)))


def require_clean(df: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """Gate after cleaning: rows exist, the label exists, nothing is null. One job."""
    require_columns(df, [spec.label])
    profile = null_profile(df).collect()
    if profile[0]["rows"] == 0:
        raise QualityError("no rows after cleaning")
    if bad := [r["column"] for r in profile if r["nulls"]]:
        raise QualityError("unexpected nulls in: " + ", ".join(bad))
    return df


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Values outside the allowed set, with their counts, as (column, value, rows)."""
    domains = CREDIT.domains if domains is None else domains
    cells = [
        F.when(
            ~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False)),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")),
        )
        for c, allowed in domains.items()
    ]
    return (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.column", "cell.value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
