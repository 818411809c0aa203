"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def long_form(columns: list[str], *keep: str, name: str = "column", value: str = "value") -> list[Column]:
    """Select list that turns double columns into (name, value) rows, keeping other columns."""
    cells = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value)) for c in columns]
    return [*(F.col(k) for k in keep), F.inline(F.array(*cells))]
