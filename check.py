"""Run queries and their SQL side by side: ``python check.py [sf_dir] [name ...]``.

Compares row count, column names and types, and the sorted rows.
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def spark_session(cpus: str = "8", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session; ``CHECK_CONF="key=value key=value"`` changes its settings."""
    builder = SparkSession.builder.master(f"local[{cpus}]")
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    session = (
        builder.appName("check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.structuredLogging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    for setting in os.environ.get("CHECK_CONF", "").split():
        session.conf.set(*setting.split("=", 1))
    return session


def duck_session(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        if math.isnan(number):
            return "nan"
        return f"{number:.9g}" if isinstance(value, float) else str(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(spark, connection, function, sql, sf_dir) -> str:
    df = function(spark, sf_dir)
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only ({len(rows)})"
    result = connection.sql(sql)
    kinds = {n: str(t) for n, t in zip(result.columns, result.types)}
    expected_columns, expected = rows_of(result.columns, result.fetchall())
    if columns != expected_columns:
        return f"MISMATCH columns {columns} {expected_columns}"
    if len(rows) != len(expected):
        return f"MISMATCH rows {len(rows)} {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want:
            return f"MISMATCH value\n   {got}\n   {want}"
    typed = {
        n: (SPARK_TYPES.get(t, t), kinds[n]) for n, t in df.dtypes if SPARK_TYPES.get(t, t) != kinds[n]
    }
    return f"ok ({len(rows)})" + (f" types differ: {typed}" if typed else "")


def main() -> int:
    from workload import QUERIES, SQL

    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark, connection = spark_session(), duck_session(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            outcome = compare(spark, connection, QUERIES[name], SQL.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += not outcome.startswith(("ok", "rows only"))
        print(f"{name:24s} {time.time() - started:6.2f}s {outcome}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
