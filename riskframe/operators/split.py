"""Splitting and sampling rows, as functions of key and seed."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.draws import below, digest, prefix_share
from riskframe.operators.positions import between
from riskframe.operators.ranking import digest_cuts, hash_ranked
from riskframe.spec import CREDIT, SEED, TEST_SHARE, TableSpec


def split_exact(
    df: DataFrame,
    shares: Mapping[str, float] | None = None,
    key: str = CREDIT.key,
    seed: int = SEED,
    stratify: str | None = None,
) -> DataFrame:
    """Add ``split`` with exact sizes: all parts but the last end at ceil(cumulative share * rows).

    Rows are taken in digest order of their key, per class when ``stratify`` is given, so the same
    row lands in the same part however the data is partitioned. Rows with equal keys stay together.
    """
    shares = shares or {"test": TEST_SHARE, "train": 1 - TEST_SHARE}
    names, ends = list(shares), list(accumulate(shares.values()))
    limits = [f"cut{i}" for i in range(len(names) - 1)]
    if stratify:
        # One row per class; adaptive execution broadcasts it or splits large classes, as its size asks for.
        joined = df.join(digest_cuts(df, key, seed, ends[:-1], stratify), stratify, "left")
    else:
        cuts = digest_cuts(df, key, seed, ends[:-1])
        joined = df.withColumns({c: cuts.select(c).scalar() for c in limits})
    order = digest(key, seed)
    part: Column = F.lit(names[-1])
    for name, limit in reversed(list(zip(names, limits, strict=False))):
        part = F.when(order <= F.col(limit), name).otherwise(part)
    return joined.withColumn("split", part).drop(*limits)


def split_stratified(df: DataFrame, label: str = CREDIT.label, key: str = CREDIT.key, seed: int = SEED) -> DataFrame:
    """70 / 15 / 15 per class."""
    return split_exact(df, {"test": 0.15, "val": 0.15, "train": 0.7}, key, seed, stratify=label)


def split_bernoulli(
    df: DataFrame, train_share: float = 1 - TEST_SHARE, key: str = CREDIT.key, seed: int = SEED
) -> DataFrame:
    """Add ``split`` by an independent draw per row; no shuffle, sizes only near the share."""
    return df.withColumn("split", F.when(prefix_share(digest(key, seed), train_share), "train").otherwise("test"))


def stamp(df: DataFrame, as_of: datetime | Column | None = None, spec: TableSpec = CREDIT) -> DataFrame:
    """Add the ingest time; pass ``as_of`` to make a run repeatable."""
    if as_of is None:
        moment = F.current_timestamp()
    else:
        moment = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.withColumn(spec.updated_at, moment)


def sample_with_replacement(df: DataFrame, n: int, key: str = CREDIT.key, seed: int = SEED) -> DataFrame:
    """``n`` uniform draws with replacement from a table with unique keys, numbered in column ``draw``."""
    places = hash_ranked(df.select(key), key, seed, rank="place", first=0)
    size = df.select(F.count(F.lit(1))).scalar()
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"), below(digest("id", "draw", seed), size).alias("place")
    )
    drawn = draws.join(places, "place").drop("place")
    return drawn.join(df, key)


def head_rows(df: DataFrame, n: int, key: str = CREDIT.key, tail: bool = False) -> DataFrame:
    """First or last ``n`` rows in key order."""
    return df.orderBy(F.col(key).desc() if tail else F.col(key).asc()).limit(n)


def row_slice(df: DataFrame, start: int, stop: int, key: str = CREDIT.key) -> DataFrame:
    """Rows ``start`` (included) to ``stop`` (excluded) in key order; rows of equal keys in an order fixed by this call."""
    return between(df, start, stop, key)
