"""Session settings and the shared folder for checkpoints and staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(name: str = "riskframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC timestamps; sizes stay with the cluster's own settings."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets a new temporary folder."""
    found = spark.conf.get(CHECKPOINT_DIR, None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="riskframe-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to a new folder below the shared one and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later stages survive lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
