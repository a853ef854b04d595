"""Upsert as joins: replace rows by key, add new ones, keep the rest.

NULL keys match nothing, so their rows are kept on the target side and added from
the source side.  The target stays the streamed (left) side of every join: a small
source is broadcast by the optimizer within its size limit and the target is not
shuffled; a large one is sort-merge joined, and a hot target key can be split by
adaptive execution, which a full outer join does not allow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tillwater.operators.keys import lookup_join, require_key


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur on more than one row."""
    return (
        require_key(df.select(*keys), *keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .drop("rows")
    )


def require_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when several source rows would update one target row."""
    repeated = repeated_keys(source, keys)
    if repeated.isEmpty():
        return
    clash = repeated.join(target.select(*keys), list(keys), "left_semi").take(1)
    if clash:
        raise ValueError(f"several source rows match one target row, e.g. {clash[0].asDict()}")


def merge_all(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, and the target rows whose key the source does not have."""
    taken = source.select(*keys)
    # equal keys of unlike types hash apart
    alike = [f.dataType for f in target.select(*keys).schema] == [f.dataType for f in taken.schema]
    kept = lookup_join(target, taken, keys, "left_anti") if alike else target.join(taken, list(keys), "left_anti")
    return kept.unionByName(source)


def merge_cols(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set: Mapping[str, str],
    values: Mapping[str, str],
    once: bool = False,
) -> DataFrame:
    """Upsert with column maps, e.g. ``{"price": "source.price"}``.

    ``set`` holds the columns to change on a match and ``values`` those of an added
    row, as SQL expressions over ``source`` and (on a match) ``target``.  Columns
    outside ``set`` keep their value; columns outside ``values`` become NULL.

    ``once`` reads each side once, by a full outer join: for a target cut down to the batch's
    partitions, whose keys are not hot.  Else the target's keys are read a second time.
    """
    unknown = [c for c in (*set, *values) if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    if once:
        return _merged_once(target, source, keys, set, values)
    flagged = source.withColumn("_matched", F.lit(True)).alias("source")
    same_key = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    matched = F.col("source._matched").isNotNull()
    updated = target.alias("target").join(flagged, same_key, "left").select(
        *[
            F.when(matched, F.expr(set[c]).cast(target.schema[c].dataType))
            .otherwise(F.col(f"target.{c}"))
            .alias(c)
            if c in set
            else F.col(f"target.{c}")
            for c in target.columns
        ]
    )
    # Keys present on both sides: at most one row per source key, whatever the target holds.
    # The lookup join leaves the distinct a shuffle of its own; without it a split of a hot
    # key would break the partitioning that the distinct relies on, and would not be done.
    present = lookup_join(target.select(*keys), source.select(*keys), keys, "left_semi").distinct()
    added = source.join(present, list(keys), "left_anti").alias("source").select(
        *[
            F.expr(values.get(c, "NULL")).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(added)


def _merged_once(target, source, keys, set, values) -> DataFrame:
    kept, new = target.withColumn("_kept", F.lit(True)), source.withColumn("_new", F.lit(True))
    same_key = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    both = kept.alias("target").join(new.alias("source"), same_key, "full")
    present, changed = F.col("target._kept").isNotNull(), F.col("source._new").isNotNull()
    columns = []
    for c in target.columns:
        kind = target.schema[c].dataType
        on_match = F.when(changed, F.expr(set[c]).cast(kind)).otherwise(F.col(f"target.{c}")) if c in set else F.col(f"target.{c}")
        columns.append(F.when(present, on_match).otherwise(F.expr(values.get(c, "NULL")).cast(kind)).alias(c))
    return both.select(*columns)


def mergeable_in_place(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> bool:
    """Whether equal keys and places hash alike on both sides, as :func:`merge_cols_in_place` needs it."""
    kinds = [(target.schema[c].dataType, source.schema[c].dataType) for c in columns]
    return all(a == b and not isinstance(a, (FloatType, DoubleType)) for a, b in kinds)


def merge_cols_in_place(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set: Mapping[str, str],
    values: Mapping[str, str],
    places: Sequence[str],
    shares: int = 1,
) -> DataFrame:
    """:func:`merge_cols` where a key has the same ``places`` (partition columns) on both sides, in one shuffle.

    Rows of both sides go by place and one of ``shares`` hashes of the key, so that each task holds
    whole shares of a few places and the result can be written by place as it lies.  A key has one
    source row at most.
    """
    located = [*keys, *places]
    rest = {"target": [c for c in target.columns if c not in located], "source": [c for c in source.columns if c not in located]}

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*located, F.struct(F.lit(True).alias("_here"), *rest[name]).alias(name))

    both = side(target, "target").unionByName(side(source, "source"), allowMissingColumns=True)
    share = F.pmod(F.xxhash64(*keys), F.lit(shares))
    dealt = both.withColumn("_share", share).repartition(*places, "_share")
    same_key = Window.partitionBy(*places, "_share", *keys)
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    found = dealt.withColumns(
        {
            "_is_target": F.col("target").isNotNull(),
            "_known": keyed & F.max(F.col("target").isNotNull()).over(same_key),
            "source": F.when(keyed & F.col("target").isNotNull(), F.first("source", ignorenulls=True).over(same_key)).otherwise(
                F.col("source")
            ),
        }
    ).filter("_is_target OR NOT _known")

    def whole(name: str) -> Column:
        return F.struct(*located, *[F.col(f"{name}.{c}").alias(c) for c in rest[name]]).alias(name)

    changed = F.col("source._here").isNotNull()
    rows = found.select("_is_target", changed.alias("_changed"), whole("target"), whole("source"))
    columns = []
    for c in target.columns:
        kind, kept = target.schema[c].dataType, F.col(f"target.{c}")
        on_match = F.when(F.col("_changed"), F.expr(set[c]).cast(kind)).otherwise(kept) if c in set else kept
        columns.append(F.when(F.col("_is_target"), on_match).otherwise(F.expr(values.get(c, "NULL")).cast(kind)).alias(c))
    return rows.select(*columns)


def same_named(columns: Sequence[str]) -> dict[str, str]:
    """A column map that takes each column from the source column of that name."""
    return {c: f"source.{c}" for c in columns}


def merge_statement(
    target: str,
    source: str,
    keys: Sequence[str],
    set: Mapping[str, str] | None = None,
    values: Mapping[str, str] | None = None,
) -> str:
    """MERGE text for a table format that supports it; without column maps, whole rows."""
    matched = "SET *" if set is None else "SET " + ", ".join(f"target.{c} = {e}" for c, e in set.items())
    added = "*" if values is None else f"({', '.join(values)}) VALUES ({', '.join(values.values())})"
    same = " AND ".join(f"target.{k} = source.{k}" for k in keys)
    return (
        f"MERGE INTO {target} AS target USING {source} AS source ON {same} "
        f"WHEN MATCHED THEN UPDATE {matched} WHEN NOT MATCHED THEN INSERT {added}"
    )
