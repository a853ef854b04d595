"""Date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than by formatting text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_columns(day: str = "full_date") -> list[Column]:
    """The 13 columns of the date dimension, from one date column."""
    return [
        F.col(day).alias("full_date"),
        date_key(day).alias("date_key"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).alias("day_number_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).cast("int").alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
    ]


def as_timestamp(as_of) -> Column:
    """A timestamp column from a datetime, text, Column or None (= now)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def days_before(as_of, days: int) -> Column:
    return as_timestamp(as_of) - F.make_dt_interval(F.lit(days))
