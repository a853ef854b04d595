"""Column names, column types and unions of unlike tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, MapType, StringType, StructField, StructType,
    TimestampNTZType, TimestampType,
)


def harmonize(df: DataFrame, renames: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename in order, each only if the source exists and the target does not yet."""
    names = {c: c for c in df.columns}
    for source, target in renames:
        if source in names.values() and target not in names.values():
            original = next(c for c, now in names.items() if now == source)
            names[original] = target
    return df.withColumnsRenamed({c: now for c, now in names.items() if c != now})


def align_union(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def typed_nulls(columns: Mapping[str, str]) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns: absent ones NULL, values that do not convert NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_conformed(field, have.get(field.name)) for field in schema.fields])


def _conformed(field: StructField, have: DataType | None) -> Column:
    want = field.dataType
    if have is None:
        return F.lit(None).cast(want).alias(field.name)
    column = F.col(field.name)
    if isinstance(want, StringType):
        nested = isinstance(have, (ArrayType, StructType, MapType))
        converted = F.to_json(column) if nested else column.cast(want)
    elif isinstance(want, ArrayType) and not isinstance(have, ArrayType):
        single = F.when(column.isNotNull(), F.array(column.try_cast(want.elementType)))
        if isinstance(have, StringType):
            converted = F.coalesce(F.from_json(column, want), single)
        else:
            converted = single
    elif isinstance(want, (DateType, TimestampType, TimestampNTZType)):
        converted = column.try_cast(want)
    else:
        converted = column if have == want else column.try_cast(want)
    return converted.alias(field.name)
