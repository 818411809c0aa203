"""Class balancing with synthetic minority rows between nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.draws import below, digest, unit
from riskframe.operators.features import max_key
from riskframe.operators.neighbors import nearest
from riskframe.operators.ranking import hash_ranked
from riskframe.spec import CREDIT, SEED, SMOTE_NEIGHBOURS, TableSpec


def class_sizes(df: DataFrame, label: str = CREDIT.label) -> dict:
    """Rows per class of a two-class label."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(3).collect()
    if len(rows) != 2:
        raise ValueError(f"balancing needs two classes in {label}, found {len(rows)}")
    return {r[label]: r["n"] for r in rows}


def smote_neighbors(
    df: DataFrame, columns: Sequence[str] = CREDIT.features, k: int = SMOTE_NEIGHBOURS, spec: TableSpec = CREDIT,
    sizes: dict | None = None, search: Callable[..., DataFrame] = nearest,
) -> DataFrame:
    """The k nearest same-class rows of every minority row; ``search`` may be ``near_by_projections`` for very many."""
    sizes = sizes or class_sizes(df, spec.label)
    minority = min(sizes, key=lambda c: (sizes[c], c))
    if sizes[minority] <= k:
        raise ValueError(f"{sizes[minority]} minority rows are too few for {k} neighbours")
    return search(df.filter(F.col(spec.label) == minority), columns, spec.key, k)


def synthetic_minority(
    df: DataFrame,
    columns: Sequence[str] = CREDIT.features,
    k: int = SMOTE_NEIGHBOURS,
    seed: int = SEED,
    start_id: int | None = None,
    spec: TableSpec = CREDIT,
    search: Callable[..., DataFrame] = nearest,
) -> DataFrame:
    """As many synthetic minority rows as the minority lacks.

    Row j draws a base row, one of its k neighbours and a share u from digests of j, and lies at
    base + u * (neighbour - base). Keys count up from ``start_id``, by default after the largest key.
    """
    sizes = class_sizes(df, spec.label)
    minority = min(sizes, key=lambda c: (sizes[c], c))
    lacking = max(sizes.values()) - sizes[minority]
    few = df.filter(F.col(spec.label) == minority).select(
        spec.key, *(F.col(c).cast("double").alias(c) for c in columns)
    )
    pairs = smote_neighbors(df, columns, k, spec, sizes, search)
    j = F.col("id")
    draws = df.sparkSession.range(lacking).select(
        j.alias("number"),
        below(digest(j, "base", seed), sizes[minority]).alias("place"),
        (1 + below(digest(j, "neighbour", seed), k)).cast("int").alias("rank"),
        unit(digest(j, "share", seed)).alias("share"),
    )
    places = hash_ranked(few.select(spec.key), spec.key, seed, rank="place", first=0)
    chosen = draws.join(places, "place").join(pairs, [spec.key, "rank"]).select(
        "number", "share", F.col(spec.key).alias("base"), "neighbour"
    )
    base = few.select(F.col(spec.key).alias("base"), F.struct(*columns).alias("x"))
    other = few.select(F.col(spec.key).alias("neighbour"), F.struct(*columns).alias("y"))
    both = chosen.join(base, "base").join(other, "neighbour")
    first = F.lit(start_id) if start_id is not None else max_key(df, key=spec.key).scalar() + 1
    between = [
        (F.col(f"x.{c}") + F.col("share") * (F.col(f"y.{c}") - F.col(f"x.{c}"))).alias(c) for c in columns
    ]
    return both.select(
        (first + F.col("number")).cast("string").alias(spec.key),
        *between,
        F.lit(minority).cast(df.schema[spec.label].dataType).alias(spec.label),
    )


def smote_balance(
    df: DataFrame, columns: Sequence[str] = CREDIT.features, k: int = SMOTE_NEIGHBOURS, seed: int = SEED,
    start_id: int | None = None, spec: TableSpec = CREDIT, search: Callable[..., DataFrame] = nearest,
) -> DataFrame:
    """Key, features as doubles and label of all rows plus the synthetic minority rows."""
    originals = df.select(spec.key, *(F.col(c).cast("double").alias(c) for c in columns), spec.label)
    return originals.unionByName(synthetic_minority(df, columns, k, seed, start_id, spec, search))
