"""Robust scaling: exact medians and interquartile ranges, applied as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordered import quartiles
from riskframe.spec import CREDIT, TableSpec


@dataclass(frozen=True)
class Scaling:
    """Fitted centre and width per column; a width of 0 counts as 1."""

    centre: dict[str, float]
    width: dict[str, float]

    def apply(self, df: DataFrame, keep: Sequence[str], order: Sequence[str]) -> DataFrame:
        """``keep`` columns, then ``order`` with fitted columns scaled."""
        out = [
            ((F.col(c) - self.centre[c]) / self.width[c]).alias(c) if c in self.centre else F.col(c) for c in order
        ]
        return df.select(*keep, *out)


def fit_scaling(df: DataFrame, columns: Sequence[str] | None = None, spec: TableSpec = CREDIT) -> Scaling:
    """Two numbers per column reach the driver."""
    rows = quartiles(df, list(columns or spec.robust)).collect()
    if empty := [r["column"] for r in rows if r["q50"] is None]:
        raise ValueError("no values to scale by in: " + ", ".join(empty))
    centre = {r["column"]: r["q50"] for r in rows}
    width = {r["column"]: (r["q75"] - r["q25"]) or 1.0 for r in rows}
    return Scaling(centre, width)


def robust_scale(fit_on: DataFrame, df: DataFrame, spec: TableSpec = CREDIT, keep: Sequence[str] | None = None):
    """Scale ``df`` with parameters from ``fit_on``: key and label, scaled columns, other features."""
    if keep is None:
        keep = [c for c in (spec.key, spec.label) if c in df.columns]
    return fit_scaling(fit_on, spec=spec).apply(df, keep, spec.scaled_order)
