"""Runs queries in Spark and their SQL counterparts in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float, Decimal)):
        return "float" if isinstance(value, float) else type(value).__name__
    return type(value).__name__


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r),
    )


def same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-12, abs_tol=1e-9)
    return _kind(left) == _kind(right) and left == right


def difference(spark_df, con, sql: str) -> str | None:
    """None if both results are the same set of rows, else what differs first."""
    got_columns = spark_df.columns
    got = rows_of(got_columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if not all(same(x, y) for x, y in zip(a, b, strict=True)):
            return f"{a} != {b}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
    )
    # Further settings to try the queries under, as key=value separated by blanks.
    for setting in os.environ.get("COMPARE_CONF", "").split():
        builder = builder.config(*setting.split("=", 1))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} differ; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")


if __name__ == "__main__":
    main()
