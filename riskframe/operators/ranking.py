"""Ranks in digest order.

A digest is uniformly distributed, so its first hex digits are ready-made ordered buckets of nearly
equal size: offsets come from a count of at most 16**DIGITS rows and ranking stays inside buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.draws import digest
from riskframe.operators.positions import positions

DIGITS = 4


def prefix(column: Column | str, digits: int = DIGITS) -> Column:
    return F.substring(column, 1, digits)


def hash_ranked(df: DataFrame, key: str, seed: int, rank: str = "rank", first: int = 1) -> DataFrame:
    """Add the row's position, from ``first``, in the order of the digest of a unique key."""
    placed = positions(df.withColumn("_digest", digest(key, seed)), ["_digest", key], rank, first)
    return placed.drop("_digest")


def digest_cuts(
    df: DataFrame, key: str, seed: int, shares: Sequence[float], by: str | None = None
) -> DataFrame:
    """The digest below or at which the first ceil(share * rows) rows lie, per share and class.

    One row per class: (by, cut0, cut1, ...). Only keys and classes are read, and only the buckets
    that hold a cut are ranked. Equal keys share a digest and are never separated.
    """
    group = [by] if by else []
    keys = df.select(*group, digest(key, seed).alias("digest")).withColumn("bucket", prefix("digest"))
    counts = keys.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("n"))
    ordered, everything = Window.partitionBy(*group).orderBy("bucket"), Window.partitionBy(*group)
    placed = counts.select(
        *group, "bucket", "n",
        (F.sum("n").over(ordered) - F.col("n")).alias("before"), F.sum("n").over(everything).alias("total"),
    )
    ranks = F.array(*(
        F.struct(F.lit(i).alias("cut"), F.ceil(F.round(F.lit(s) * F.col("total"), 6)).alias("rank"))
        for i, s in enumerate(shares)
    ))
    holding = (
        placed.select(*group, "bucket", "n", "before", F.inline(ranks))
        .filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
        .select(*group, "bucket", "cut", (F.col("rank") - F.col("before")).alias("rank"))
    )
    inside = Window.partitionBy(*group, "bucket", "cut").orderBy("digest")
    found = (
        keys.join(holding, [*group, "bucket"])
        .groupBy(*group, "bucket", "cut", "rank", "digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("last", F.sum("n").over(inside))
        .filter((F.col("last") >= F.col("rank")) & (F.col("last") - F.col("n") < F.col("rank")))
    )
    return found.groupBy(*group).agg(
        *(F.max(F.when(F.col("cut") == i, F.col("digest"))).alias(f"cut{i}") for i in range(len(shares)))
    )

