"""Run registered queries and compare them with their SQL in DuckDB.

    python -m checks.compare [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def difference(spark: SparkSession, con, sf_dir: str, key: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[key](spark, sf_dir)
    ours = df.collect()
    if key not in ORACLES:
        return None
    got = con.execute(ORACLES[key])
    names = [c[0] for c in got.description]
    theirs = got.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if a == b:
        return None
    return f"{len(ours)} vs {len(theirs)} rows; only ours {list((a - b))[:2]}; only sql {list((b - a))[:2]}"


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("keys", nargs="*")
    a = p.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(a.sf)
    bad = 0
    for key in a.keys or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, a.sf, key)
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        kind = "sql " if key in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {time.time() - start:6.1f}s {key} {found or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
