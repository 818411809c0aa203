"""Synthetic rows from column profiles, as functions of row number and seed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.draws import below, digest, normal, unit
from riskframe.operators.clean import inject_drift
from riskframe.operators.features import max_key
from riskframe.operators.profile import DISCRETE_AT_MOST, distinct_values, numeric_columns
from riskframe.spec import CREDIT, SEED, TableSpec

SURELY_MANY = 1_000


def profiled(df: DataFrame, numbers: list[str], times: list[str]) -> dict[str, dict]:
    """Mean, deviation, sketch of the distinct count and presence of nulls per number; range per time. One pass."""
    figures = []
    for i, c in enumerate(numbers):
        v = F.col(c).cast("double")
        figures += [F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                    F.approx_count_distinct(v).alias(f"values{i}"), F.bool_or(v.isNull()).alias(f"gaps{i}")]
    for i, c in enumerate(times):
        micros = F.unix_micros(F.col(c).cast("timestamp"))
        figures += [F.min(micros).alias(f"low{i}"), F.max(micros).alias(f"high{i}")]
    row = df.agg(*figures).first()
    found = {c: {k: row[f"{k}{i}"] for k in ("mean", "std", "values", "gaps")} for i, c in enumerate(numbers)}
    found.update({c: {k: row[f"{k}{i}"] for k in ("low", "high")} for i, c in enumerate(times)})
    return found


def discrete_values(df: DataFrame, profile: dict[str, dict], at_most: int = DISCRETE_AT_MOST) -> dict[str, list]:
    """Sorted distinct values, null included, of the columns with at most ``at_most`` of them.

    The sketch rules out columns with clearly more values; of the others, no more than ``at_most`` + 1
    values per column leave the tasks.
    """
    maybe = [c for c, p in profile.items() if p.get("values", SURELY_MANY + 1) <= SURELY_MANY]
    if not maybe:
        return {}
    place = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    first = distinct_values(df, maybe).withColumn("place", place).filter(F.col("place") <= at_most + 1)
    found: dict[str, list] = {c: [None] if profile[c]["gaps"] else [] for c in maybe}
    for r in first.orderBy("column", "value").collect():
        found[r["column"]].append(r["value"])
    return {c: v for c, v in found.items() if len(v) <= at_most}


def synthesize(
    df: DataFrame,
    rows: int = 100,
    seed: int = SEED,
    drift: bool = False,
    existing: DataFrame | None = None,
    start_id: int | None = None,
    as_of: datetime | None = None,
    spec: TableSpec = CREDIT,
) -> DataFrame:
    """``rows`` new rows that resemble ``df`` column by column.

    Numeric columns with at most 10 distinct values draw uniformly from these values; payment columns
    are absolute normal draws cut to whole numbers; other numeric columns are rounded normal draws.
    Times are uniform between the latest one and ``as_of``. Other columns are left out. Keys count up
    after the largest key of ``existing`` (default ``df``). Only the profile reaches the driver.
    """
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    profile = profiled(df, numeric_columns(df, spec.key), times)
    few = discrete_values(df, profile)
    if start_id is None:
        start_id = max_key(df if existing is None else existing, key=spec.key).first()["top"] + 1
    now = F.unix_micros(F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp"))

    j = F.col("id")
    out = [(j + start_id).cast("string").alias(spec.key)]
    for f in df.schema.fields:
        c, draw = f.name, digest(j, f.name, seed)
        if c in few:
            choices = F.array(*(F.lit(v).cast("double") for v in few[c]))
            out.append(F.element_at(choices, (1 + below(draw, len(few[c]))).cast("int")).cast(f.dataType).alias(c))
        elif c in times:
            low, high = profile[c]["low"], F.lit(profile[c]["high"])
            later = high + F.floor(unit(draw) * (now - high)).cast("long")
            moment = F.when((F.lit(low) < high) & (high < now), later).otherwise(high)
            out.append(F.timestamp_micros(moment).cast(f.dataType).alias(c))
        elif c in profile:
            value = profile[c]["mean"] + profile[c]["std"] * normal(draw)
            whole = F.abs(value).cast("long") if c.startswith("Pay_amt") else F.bround(value, 0)
            out.append(whole.cast("double").alias(c))
    made = df.sparkSession.range(rows).select(*out)
    return inject_drift(made) if drift else made
