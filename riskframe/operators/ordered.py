"""Exact order statistics without a global sort."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.ratios import long_form
from riskframe.operators.positions import running

ACCURACY = 2_000
POINTS = 1_000
SALTS = 32
MARGIN = 4e-3


def number_list(numbers: Sequence[float]) -> str:
    """SQL text of an array of doubles: one expression instead of one call per number."""
    return "array(" + ", ".join(f"{float(v)!r}D" for v in numbers) + ")"


Figures = Mapping[str, Callable[[Column], Column]]


def column_brackets(df: DataFrame, columns: list[str], probabilities: Sequence[float]) -> DataFrame:
    """(brackets), one row: per column, in order, two values around every quantile.

    Tasks are dealt to a few sketches; each gives evenly spaced points that stand for equal shares of
    its rows, and the brackets are read off these points. Sketch error, spacing and rounding together
    stay within MARGIN.
    """
    places = number_list([i / POINTS for i in range(POINTS + 1)])
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")).agg(*(
        f for i, c in enumerate(columns) for f in (
            F.expr(f"percentile_approx(`{c}`, {places}, {ACCURACY})").alias(f"points{i}"), F.count(c).alias(f"n{i}"))
    ))
    points = sketches.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(f"points{i}").alias("points"), F.col(f"n{i}").alias("n"))
        for i, c in enumerate(columns)
    )))).select("column", "n", F.explode_outer("points").alias("value"))
    # At most SALTS * (POINTS + 1) rows per column.
    order = Window.partitionBy("column").orderBy(F.col("value").asc_nulls_first())
    placed = points.select(
        "column", "value", F.when(F.col("value").isNull(), 0).otherwise(F.col("n")).alias("n")
    ).withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("column")))
    ends = []
    for p in probabilities:
        low = F.max(F.when(F.col("upto") <= (p - MARGIN) * F.col("all"), F.col("value")))
        high = F.min(F.when(F.col("upto") >= (p + MARGIN) * F.col("all"), F.col("value")))
        ends += [F.coalesce(low, F.lit(-math.inf)), F.coalesce(high, F.lit(math.inf))]
    total = F.floor(F.max("all") / (POINTS + 1))
    per_column = placed.groupBy("column").agg(F.array(*ends).alias("ends"), total.alias("total"))
    found = F.map_from_entries(F.collect_list(F.struct("column", F.struct("column", "ends", "total"))))
    return per_column.agg(found.alias("m")).select(
        F.array(*(F.element_at("m", F.lit(c)) for c in columns)).alias("brackets")
    )


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), also: Figures | None = None
) -> DataFrame:
    """Exact linear-interpolated quantiles: (by..., column, quantiles array in the order asked).

    Values collapse to distinct ones with counts, and running counts over key ranges tell which value holds a rank; no task
    sorts a whole column or a whole group. Of whole columns only the values near the quantiles take part: sketches bracket
    each within a small share of the rows, and the values below a bracket are one count. A value missed by its bracket
    would be an error, never a wrong number. A group of nulls only has null quantiles. ``also`` adds aggregates of every
    column (nulls included) to grouped quantiles. The columns of ``by`` must not be null.
    """
    by, columns, also = list(by), list(columns), dict(also or {})
    if also and not by:
        raise ValueError("aggregates go with grouped quantiles only")
    numbers = df.select(*by, *(F.col(f"`{c}`").cast("double").alias(c) for c in columns))
    if by:
        return grouped_quantiles(numbers, columns, probabilities, by, also)
    return column_quantiles(numbers, columns, probabilities)


def ranks(probabilities: Sequence[float], total: Column) -> list[tuple[Column, Column, Column]]:
    """The two ranks around each quantile, from 0, and the share of the way between them."""
    places = [F.lit(float(p)) * (total - 1) for p in probabilities]
    return [(F.floor(p), F.ceil(p), p - F.floor(p)) for p in places]


def interpolated(held: Sequence[tuple[Column, Column]], probabilities: Sequence[float], total: Column) -> Column:
    """Array of quantiles from the values at both ranks; null for no values, an error if a value is missing."""
    missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    return F.array(*(
        F.when(total > 0, F.coalesce(low + (high - low) * share, missed))
        for (low, high), (_, _, share) in zip(held, ranks(probabilities, total), strict=True)
    ))


def grouped_quantiles(numbers: DataFrame, columns: list[str], probabilities: Sequence[float], by: list[str], also: Figures) -> DataFrame:
    group = [*by, "column"]
    counted = numbers.select(*long_form(columns, *by)).filter(F.col("value").isNotNull()).groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    placed = running(counted, group, "value", ["n"])
    value, upto, total = F.col("value"), F.col("n_upto"), F.col("n_all")

    def holds(rank: Column) -> Column:
        return (rank >= upto - F.col("n")) & (rank < upto)

    asked = ranks(probabilities, total)
    some = F.lit(False)
    for low, high, _ in asked:
        some = some | holds(low) | holds(high)
    held = placed.filter(some).groupBy(*group).agg(F.max("n_all").alias("total"), *(
        F.max(F.when(holds(rank), value)).alias(f"at{i}{side}") for i, (low, high, _) in enumerate(asked) for side, rank in (("low", low), ("high", high))
    ))
    found = held.select(
        *group, interpolated([(F.col(f"at{i}low"), F.col(f"at{i}high")) for i in range(len(asked))], probabilities, F.col("total")).alias("quantiles")
    )
    figures = [f(F.col("value")).alias(name) for name, f in also.items()] or [F.count(F.lit(1)).alias("_rows")]
    every = numbers.select(*long_form(columns, *by)).groupBy(*group).agg(*figures)
    unknown = F.array(*(F.lit(None).cast("double") for _ in probabilities))
    return every.join(found, group, "left").select(*group, *also, F.coalesce("quantiles", unknown).alias("quantiles"))


def column_quantiles(numbers: DataFrame, columns: list[str], probabilities: Sequence[float]) -> DataFrame:
    n, value, ends = len(probabilities), F.col("value"), F.col("ends")
    wide = numbers.withColumn("brackets", column_brackets(numbers, columns, probabilities).scalar())
    values = wide.select(F.inline(F.array(*(
        F.struct(F.col(f"`{c}`").alias("value"), F.col("brackets")[i].alias("bracket")) for i, c in enumerate(columns)
    )))).select("value", "bracket.*")

    def cell(i: int) -> Column:
        """The value if inside bracket i, only a mark if below, nothing if above."""
        inside = F.struct(F.lit(i).alias("i"), value.alias("value"))
        below = F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("value"))
        return F.when(value < ends[2 * i], below).when(value <= ends[2 * i + 1], inside)

    counted = (
        values.filter(value.isNotNull() | (F.col("total") == 0))
        .select("column", "total", F.inline(F.array_compact(F.array(*map(cell, range(n))))))
        .groupBy("column", "total", "i", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    placed = running(counted, ["column", "i"], "value", ["n"])
    upto, total = F.col("n_upto"), F.col("total")

    def at(i: int, rank: Column) -> Column:
        return F.max(F.when((F.col("i") == i) & (rank >= upto - F.col("n")) & (rank < upto), value))

    read = placed.groupBy("column", "total").agg(*(
        at(i, rank).alias(f"at{i}{side}") for i, (low, high, _) in enumerate(ranks(probabilities, total)) for side, rank in (("low", low), ("high", high))
    ))
    found = read.select("column", interpolated([(F.col(f"at{i}low"), F.col(f"at{i}high")) for i in range(n)], probabilities, total).alias("quantiles"))
    # A column without values has no counted rows.
    unknown = F.array(*(F.lit(None).cast("double") for _ in probabilities))
    every = numbers.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(F.broadcast(found), "column", "left").select("column", F.coalesce("quantiles", unknown).alias("quantiles"))


def quartiles(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), also: Figures | None = None) -> DataFrame:
    """(by..., column, aggregates of ``also``..., q25, q50, q75)."""
    q = quantiles(df, columns, [0.25, 0.5, 0.75], by, also=also)
    named = [F.col("quantiles")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])]
    return q.select(*by, "column", *(also or ()), *named)
