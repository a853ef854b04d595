"""Rows by key: required keys, latest version, deduplication, lookup, numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.functions.dates import days_before
from tillwater.functions.hashing import hash_id


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns {missing} not found in {df.columns}")


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all filled, as plain IS NOT NULL filters the scan can use."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def recent(df: DataFrame, ts: str, days: int, as_of) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; a plain filter the scan can use."""
    return df.filter(F.col(ts) >= days_before(as_of, days))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key in ``order``; ties are broken by all other columns.

    The filter sits right above ``row_number``, so each map task keeps one row per
    key before the shuffle and a hot key costs at most one row per task.  A hash of the keys leads
    the sort: numbers tell most rows apart, where texts that begin alike are compared in full.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order, *rest)
    return df.withColumn("row_num", F.row_number().over(window)).filter("row_num = 1").drop("row_num")


def least_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the first by the other columns in their order, NULLs last.

    One grouping with partial aggregation, for rows that mostly repeat each other.
    """
    rest = [c for c in df.columns if c not in keys]
    if len(rest) == 1:
        # no struct, which grouping would have to sort for
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0])).select(*df.columns)
    ranked = F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"{c}__none"), F.col(c).alias(c))])
    found = df.groupBy(*keys).agg(F.min(ranked).alias("_least"))
    return found.select(*[F.col(c) if c in keys else F.col(f"_least.{c}").alias(c) for c in df.columns])


def latest(df: DataFrame, keys: Sequence[str], ts: str, drop: Sequence[str] = ()) -> DataFrame:
    """The newest row per key by ``ts``, without the helper columns in ``drop``."""
    require_columns(df, [*keys, ts])
    return first_per_key(df, keys, [F.col(ts).desc_nulls_last()]).drop(*drop)


def dedup_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the first in ``order`` and then by the other columns."""
    return first_per_key(df, keys, list(order))


def only_new(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return df.join(existing.select(key), key, "left_anti")


def lookup_join(df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a dim with one row per key, so that a hot key of ``df`` can be split.

    Adaptive execution splits a skewed partition only where both sides were shuffled
    for this join, and where no later step relies on the join's partitioning.  A dim that
    was just grouped by the key, or a later grouping by it, rules the split out.  A hash of
    the key as one more join column gives the join a partitioning that nothing else uses, and
    as the first one it keeps the sort from comparing texts.
    A dim within the broadcast limit is broadcast and nothing is shuffled.
    """
    tag = F.xxhash64(*keys)
    joined = df.withColumn("_key_hash", tag).join(
        dim.withColumn("_key_hash", tag), ["_key_hash", *keys], how
    )
    return joined.drop("_key_hash")


def resolve(df: DataFrame, dim: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add ``value`` of the matching dim row, NULL when there is none; no row is repeated.

    The dim shrinks to one row per key by partial aggregation (smallest value wins).
    """
    lookup = require_key(dim, *keys).groupBy(*keys).agg(F.min(value).alias(value))
    return lookup_join(df, lookup, keys)


def surrogate(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return df.withColumn(name, hash_id(*keys))


def date_ids(df: DataFrame, day: str = "full_date") -> DataFrame:
    """Distinct dates numbered in ascending order.

    The one-task window sees one row per calendar day, however large ``df`` is.
    """
    dates = df.select(day).distinct()
    return dates.withColumn("date_id", F.row_number().over(Window.orderBy(F.col(day).asc_nulls_first())))
