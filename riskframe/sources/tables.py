"""Writing and maintaining catalog tables. Rows are always matched to columns by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.scan import conform


def quoted(name: str) -> str:
    return ".".join(f"`{p.strip('`')}`" for p in name.split("."))


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace the content of a table that ``df`` does not read."""
    df.write.mode("overwrite").saveAsTable(quoted(name))


def rewrite_table(df: DataFrame, name: str) -> None:
    """Replace a table by rows computed from it: write a staging table first, then copy it over."""
    spark = df.sparkSession
    staging = f"{name.strip('`')}__staging"
    overwrite_table(df, staging)
    overwrite_table(spark.table(quoted(staging)), name)
    spark.sql(f"DROP TABLE {quoted(staging)}")


def finish_rewrite(spark: SparkSession, name: str) -> None:
    """Copy over what a rewrite that died had staged completely; does nothing otherwise."""
    staging = f"{name.strip('`')}__staging"
    if spark.catalog.tableExists(quoted(staging)):
        overwrite_table(spark.table(quoted(staging)), name)
        spark.sql(f"DROP TABLE {quoted(staging)}")


def append_table(df: DataFrame, name: str) -> int:
    """Append by column name and report how many rows went in, counted while they were written."""
    spark = df.sparkSession
    written = Observation()
    target = quoted(name)
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if spark.catalog.tableExists(target):
        rows = conform(rows, spark.table(target).schema)
    rows.write.mode("append").saveAsTable(target)
    return written.get["rows"]


def insert_by_name(spark: SparkSession, target: str, query: str, **args: object) -> None:
    """``INSERT INTO ... BY NAME`` with typed parameters instead of text pasted into the statement."""
    spark.sql(f"INSERT INTO {quoted(target)} BY NAME {query}", args=args)


def create_keyed_table(df: DataFrame, name: str, key: str) -> None:
    """Create or replace a table whose key is present in every row; the write fails on a null key."""
    present = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null key {key} for {name}"))).otherwise(F.col(key))
    overwrite_table(df.withColumn(key, present), name)


DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def overwrite_partitions(df: DataFrame, name: str, by: str) -> None:
    """Replace the partitions that ``df`` has rows of; all others stay. The table is made if it is not there."""
    spark, target = df.sparkSession, quoted(name)
    if not spark.catalog.tableExists(target):
        df.write.partitionBy(by).saveAsTable(target)
        return
    before = spark.conf.get(DYNAMIC, None)
    spark.conf.set(DYNAMIC, "dynamic")
    try:
        conform(df, spark.table(target).schema).write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(DYNAMIC, before) if before is not None else spark.conf.unset(DYNAMIC)
