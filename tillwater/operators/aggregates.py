"""High-water marks, first dates, id lists, last writers, previews and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.functions.hashing import chunk_of
from tillwater.operators.keys import require_key


def high_water(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(column))


def first_date(
    df: DataFrame, column: str, as_of, by: Sequence[str] = (), days_back: int = 1, name: str = "first_date"
) -> DataFrame:
    """The smallest date that parses, moved back; ``as_of`` moved back where none parses."""
    earliest = F.min(F.col(column).try_cast("date"))
    fallback = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
    return df.groupBy(*by).agg(
        F.date_sub(F.coalesce(earliest, fallback), days_back).alias(name)
    )


def id_lists(df: DataFrame, value: str, id_column: str, chunks: int) -> DataFrame:
    """Sorted id lists per value, as rows (value, chunk, ids).

    A hash of the id deals every value's ids out over ``chunks`` lists, which the caller
    chooses, so that no task holds a hot value's whole list; together they hold every id.
    """
    rows = require_key(df.select(value, id_column), value, id_column)
    return (
        rows.withColumn("chunk", chunk_of(chunks, id_column))
        .groupBy(value, "chunk")
        .agg(F.sort_array(F.collect_list(id_column)).alias("ids"))
    )


def last_writer(batches: Sequence[DataFrame], key: str, value: str) -> DataFrame:
    """One value per key: that of the last batch that has the key.

    Within a batch the largest value wins, so the result does not depend on row order.
    """
    ordered = [
        batch.select(key, value, F.lit(place).alias("_batch")) for place, batch in enumerate(batches)
    ]
    return (
        reduce(DataFrame.unionByName, ordered)
        .groupBy(key)
        .agg(F.max_by(value, F.struct("_batch", value)).alias(value))
    )


def preview(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows in a total order; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the keys; the same rows on every run."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(draw, *keys).limit(n)
