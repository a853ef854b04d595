"""The date dimension: a span of days, and the days still missing up to a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.dates import as_timestamp, calendar_columns
from tillwater.operators.aggregates import high_water
from tillwater.operators.keys import only_new
from tillwater.sources.tables import publish, read_table

# The span of the first build.
FIRST_DAY = "2018-11-22"
LAST_DAY = "2019-03-19"


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day of each (start_date, end_date) row; none where start > end."""
    days = bounds.filter("start_date <= end_date").select(
        F.explode(F.sequence("start_date", "end_date")).alias("full_date")
    )
    return days.select(*calendar_columns("full_date"))


def first_dates(spark: SparkSession, start: str = FIRST_DAY, end: str = LAST_DAY) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date")
    )
    return date_dimension(bounds)


def missing_dates(dim_times: DataFrame, as_of=None) -> DataFrame:
    """Days after the last known one up to ``as_of``; none for an empty table."""
    today = as_timestamp(as_of).cast("date")
    bounds = high_water(dim_times, "full_date").select(
        F.date_add(F.coalesce("full_date", today), 1).alias("start_date"), today.alias("end_date")
    )
    return only_new(date_dimension(bounds), dim_times, "full_date").select(*dim_times.columns)


def extend_dim_times(spark: SparkSession, path: str, as_of=None, fmt: str = "parquet") -> None:
    rows = missing_dates(read_table(spark, path, fmt), as_of)
    if not rows.isEmpty():
        publish(rows, path, "append", fmt)
