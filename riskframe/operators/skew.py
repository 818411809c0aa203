"""Joining a log with hot keys to a table that is unique per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 256
SALTS = 64


def hot_keys(left: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of all rows; there are fewer than 1 / share of them."""
    counted = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    size = counted.agg(F.sum("_n")).scalar()
    return counted.filter((F.col("_n") > size * share) & F.col(key).isNotNull()).select(key)


def salted_join(
    left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left",
    hot: DataFrame | None = None, salts: int = SALTS,
) -> DataFrame:
    """Equi-join where rows of hot keys are spread over ``salts`` tasks.

    ``right`` has one row per key; only its rows of hot keys are repeated, ``salts`` times each.
    ``spread`` is a left column that differs between rows of one key. ``hot`` replaces the keys found
    by ``hot_keys``, which has to give the same keys whenever it is computed.
    """
    hot = (hot_keys(left, key) if hot is None else hot).withColumn("_hot", F.lit(True))
    marked_left = left.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0).cast("long"))
    ).drop("_hot")
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    places = F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0).cast("long")))
    marked_right = (
        right.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(places))
        .drop("_hot")
    )
    return marked_left.join(marked_right, [key, "_salt"], how).drop("_salt")
