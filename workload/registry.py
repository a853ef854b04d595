"""The queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def without_time_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the session's wall clock, so that no client zone shifts them."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def query(sql: str | None = None, name: str | None = None):
    """Register the function under ``name`` (its own by default), with its SQL."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_time_zone(function(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return function

    return register
