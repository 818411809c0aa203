"""A keyed latest-value table fed by a change stream.

Batches lie in folders of their own. A snapshot holds the newest version of every key as of some batch, removed keys as
well, so that an older version that comes late does not bring a key back. Readers follow the last finished snapshot and the
batches after it; what was before is neither listed nor read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.sources.scan import folders
from riskframe.spec import CREDIT
from riskframe.streaming.sinks import batch_path, drain_batches

GONE = "_gone"


def newest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the latest version; of equal versions a removal wins, then later columns decide."""
    rest = [F.col(c).desc() for c in rows.columns if c not in (key, version, GONE)]
    order = Window.partitionBy(key).orderBy(F.col(version).desc(), F.col(GONE).desc(), *rest)
    return rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") == 1).drop("_place")


def stream_upsert(
    changes: DataFrame, root: str, checkpoint: str, key: str = CREDIT.key, version: str = CREDIT.updated_at,
    deletes: str | None = None,
) -> None:
    """Store every batch, reduced to one row per key. ``deletes`` names a boolean column that removes the key."""
    gone: Column = F.coalesce(F.col(deletes), F.lit(False)) if deletes else F.lit(False)

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn(GONE, gone).drop(*([deletes] if deletes else []))
        newest(marked, key, version).write.mode("overwrite").parquet(batch_path(f"{root}/batches", batch_id))

    drain_batches(changes, write, checkpoint)


def finished(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """Number to folder of the finished writes below a path."""
    numbers = {int(n.removeprefix(prefix)): f"{path}/{n}" for n in folders(spark, path) if n.startswith(prefix)}
    return {n: p for n, p in numbers.items() if "_SUCCESS" in folders(spark, p)}


def versions(spark: SparkSession, root: str) -> tuple[DataFrame | None, int]:
    """Rows of the last snapshot and of the batches after it, and the last batch's number."""
    snapshots = finished(spark, f"{root}/snapshots", "upto=")
    start = max(snapshots, default=-1)
    batches = {n: f"{root}/batches/batch={n}" for n in (int(x.removeprefix("batch=")) for x in folders(spark, f"{root}/batches") if x.startswith("batch=")) if n > start}
    paths = [*([snapshots[start]] if snapshots else []), *batches.values()]
    return (spark.read.parquet(*paths) if paths else None), max([start, *batches])


def latest(spark: SparkSession, root: str, key: str = CREDIT.key, version: str = CREDIT.updated_at) -> DataFrame:
    """The table as of the last batch."""
    rows, _ = versions(spark, root)
    if rows is None:
        raise FileNotFoundError(f"no batch under {root}")
    return newest(rows, key, version).filter(~F.col(GONE)).drop(GONE)


def compact(spark: SparkSession, root: str, key: str = CREDIT.key, version: str = CREDIT.updated_at) -> int:
    """Write a snapshot as of the last batch and return that batch's number; it counts once its write has ended."""
    rows, last = versions(spark, root)
    if rows is None:
        raise FileNotFoundError(f"no batch under {root}")
    newest(rows, key, version).write.mode("overwrite").parquet(f"{root}/snapshots/upto={last}")
    return last
