"""Reading inputs and bringing them to a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.schemas import raw_schema


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """Headered CSV with the declared schema, or with inferred types on request."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if infer else reader.schema(schema or raw_schema())
    try:
        return reader.csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by name; parts with special characters are back-quoted."""
    parts = [p.strip("`") for p in name.split(".")]
    return spark.table(".".join(f"`{p}`" for p in parts))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in the order and types of ``schema``; a missing column is an analysis error."""
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder of any store that Spark reads; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in store.listStatus(where)) if store.exists(where) else []
