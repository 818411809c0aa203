"""Positions and running sums in a global order, without sorting a table in one task.

Rows are range-partitioned by the order and stored, so that their range and place stay fixed. Every range counts its rows;
the counts of the ranges before it, one row per range, give the offset. Rows that are equal in the order are told apart by
where they were read, so a frequent value is cut into ranges like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import stored

#: The first bits of a row number are its partition, these many are its place inside.
PLACE_BITS = 33


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored rows with ``_range``, numbered in order, and ``_place`` inside the range, from 0."""
    number = F.monotonically_increasing_id()
    dealt = df.withColumn("_tie", number).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    place = F.col("_number").bitwiseAND(2**PLACE_BITS - 1)
    numbered = dealt.withColumn("_number", number).select(*df.columns, F.shiftright("_number", PLACE_BITS).alias("_range"), place.alias("_place"))
    return stored(numbered, "ranged")


def range_counts(placed: DataFrame, **also) -> DataFrame:
    """(_range, rows, aggregates of ``also``): one row per range."""
    return placed.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"), *(f.alias(n) for n, f in also.items()))


def positions(df: DataFrame, order: Sequence[str], name: str = "position", first: int = 0) -> DataFrame:
    """Rows with their position, from ``first``, in ascending order, nulls first.

    Rows equal in ``order`` follow each other in an order that is fixed by this call.
    """
    placed = ranged(df, order)
    counts = range_counts(placed)
    # One row per range, and there are as many ranges as shuffle partitions.
    offsets = counts.select("_range", (F.sum("rows").over(Window.orderBy("_range")) - F.col("rows") + first).alias("_offset"))
    at = placed.join(F.broadcast(offsets), "_range")
    return at.select(*df.columns, (F.col("_offset") + F.col("_place")).alias(name))


def running(df: DataFrame, group: Sequence[str], value: str, sums: Sequence[str]) -> DataFrame:
    """Adds, per column of ``sums``, ``<column>_upto``, its sum over the rows of the group up to this one in order of
    ``value``, and ``<column>_all``, its sum over the group.

    ``value`` differs between the rows of a group; group columns are not null. A group that lies inside one range is summed
    there. The parts of the others, at most two rows per range, carry what came before them and are broadcast.
    """
    group, own = list(group), [f"_own_{c}" for c in sums]
    placed = ranged(df, [*group, value])
    parts = placed.groupBy(*group, "_range").agg(*(F.sum(c).alias(o) for c, o in zip(sums, own, strict=True)))
    whole = Window.partitionBy(*group)
    cut = parts.withColumn("_parts", F.count(F.lit(1)).over(whole)).filter(F.col("_parts") > 1).select(
        *group, "_range",
        *((F.sum(o).over(whole.orderBy("_range")) - F.col(o)).alias(f"_before{o}") for o in own),
        *(F.sum(o).over(whole).alias(f"_all{o}") for o in own),
    )
    here = Window.partitionBy("_range", *group)
    summed = placed.select("*", *(F.sum(c).over(here.orderBy("_place")).alias(f"_upto{o}") for c, o in zip(sums, own, strict=True)),
                           *(F.sum(c).over(here).alias(o) for c, o in zip(sums, own, strict=True)))
    carried = summed.join(F.broadcast(cut), [*group, "_range"], "left")
    return carried.select(
        *df.columns,
        *((F.col(f"_upto{o}") + F.coalesce(f"_before{o}", F.lit(0))).alias(f"{c}_upto") for c, o in zip(sums, own, strict=True)),
        *(F.coalesce(f"_all{o}", o).alias(f"{c}_all") for c, o in zip(sums, own, strict=True)),
    )


def between(df: DataFrame, start: int, stop: int, key: str) -> DataFrame:
    """Rows at positions ``start`` (included) to ``stop`` (excluded) in key order, nulls first.

    Keys alone are put into ranges first. Rows are then read between the least and the greatest key of the ranges that
    hold the slice, and only these rows get positions.
    """
    if stop <= start:
        return df.limit(0)
    keys = ranged(df.select(F.col(key).alias("_key")), ["_key"])
    ends = range_counts(keys, low=F.min("_key"), high=F.max("_key"), nulls=F.count_if(F.col("_key").isNull()))
    upto = F.sum("rows").over(Window.orderBy("_range"))  # one row per range
    holding = ends.withColumn("upto", upto).filter((F.col("upto") > start) & (F.col("upto") - F.col("rows") < stop))
    low, high, nulls = holding.agg(F.min("low"), F.max("high"), F.sum("nulls")).first()
    if nulls is None:
        return df.limit(0)
    key_column, null = F.col(f"`{key}`"), F.lit(bool(nulls))
    inside = (key_column.isNull() & null) | F.coalesce((key_column >= F.lit(low)) & (key_column <= F.lit(high)), F.lit(False))
    skipped = 0 if nulls else keys.filter(F.col("_key").isNull() | (F.col("_key") < F.lit(low))).count()
    placed = positions(df.filter(inside), [key], "_position", skipped)
    return placed.filter((F.col("_position") >= start) & (F.col("_position") < stop)).drop("_position")
