"""Layer tables: scan, publish, append, upsert and the landed-data check.

A table of files may be laid out in hidden folders, whose names say how a row finds its own:
``bucket_of_<n>`` by a hash of the keys, ``div_<n>_of_<column>`` by a whole-number column divided by n (100
for the months of a yyyyMMdd key).  Writers derive them, readers do not see them, and an upsert
rewrites the folders that its batch touches.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from tillwater.operators.keys import lookup_join
from tillwater.operators.upsert import (
    merge_all, merge_cols, merge_cols_in_place, merge_statement, mergeable_in_place, require_single_match,
)
from tillwater.sources import files

# Formats whose table is just the files below its path.
FILE_FORMATS = {"parquet", "orc", "json", "csv"}
# Formats that keep their own schema, so a write can be checked against it.
TYPED_FORMATS = {"parquet", "orc", "delta"}
# The view that a MERGE reads its batch from.
MERGE_SOURCE = "_upsert_source"
# About how many rows of a folder one task merges.
ROWS_AT_ONCE = 1_000_000
# The folder that Spark writes rows without a partition value to.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
BUCKETS = re.compile(r"bucket_of_(\d+)")
QUOTIENT = re.compile(r"div_(\d+)_of_(\w+)")


@dataclass(frozen=True)
class ColumnMap:
    """What a MERGE sets on a match and inserts otherwise, as SQL over ``source`` and ``target``."""

    set: Mapping[str, str]
    values: Mapping[str, str]


def is_hidden(column: str) -> bool:
    return bool(BUCKETS.fullmatch(column) or QUOTIENT.fullmatch(column))


def _derived(column: str, keys: Sequence[str]) -> Column:
    if found := BUCKETS.fullmatch(column):
        # as text, so that a key keeps its folder when its type is widened
        text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
        return F.pmod(F.xxhash64(*text), F.lit(int(found[1]))).cast("int")
    size, name = QUOTIENT.fullmatch(column).groups()
    return F.floor(F.col(name) / int(size)).cast("int")


def laid_out(df: DataFrame, partition_by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with the hidden columns among ``partition_by``."""
    return df.withColumns({c: _derived(c, keys) for c in partition_by if is_hidden(c)})


def layout_of(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """The hidden columns that a table on disk is laid out by."""
    if fmt not in FILE_FORMATS:
        return []
    return [c for c in spark.read.format(fmt).load(path).columns if is_hidden(c)]


def _previous(path: str) -> str:
    return f"{path.rstrip('/')}.previous"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is at ``path``; a swap that was cut short is an error, see :func:`mend`."""
    if files.exists(spark, path):
        return True
    if files.exists(spark, _previous(path)):
        raise RuntimeError(f"a publish to {path} was cut short or is under way; if none is, call mend()")
    return False


def mend(spark: SparkSession, path: str) -> bool:
    """Undo a swap that was cut short: the table before it is back.  True if there was one.

    To be called when no publish is under way, which only the caller can know.
    """
    if files.exists(spark, path) or not files.exists(spark, _previous(path)):
        return False
    files.move(spark, _previous(path), path)
    return True


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    rows = _with_folders(spark, path, fmt, schema)
    return rows.drop(*[c for c in rows.columns if is_hidden(c)])


def _with_folders(spark: SparkSession, path: str, fmt: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path)
    # a partition column of a table without rows has no type
    untyped = [f.name for f in rows.schema.fields if isinstance(f.dataType, NullType)]
    return rows.withColumns({c: F.col(c).cast("string") for c in untyped}) if untyped else rows


def _types(schema: StructType, skip: Sequence[str]) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields if f.name not in skip}


def _as_existing(df: DataFrame, existing: StructType, partition_by: Sequence[str]) -> DataFrame:
    """Order the columns as the table has them; add typed NULLs for absent ones."""
    extra = [c for c in df.columns if c not in existing.names]
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    have, want = _types(df.schema, partition_by), _types(existing, partition_by)
    changed = {c: (have[c], want[c]) for c in have if have[c] != want[c]}
    if changed:
        raise ValueError(f"column types differ from the table: {changed}")
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in existing.fields
        ]
    )


def publish(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    replace_schema: bool = False,
    partition_by: Sequence[str] = (),
    keys: Sequence[str] = (),
    gathered: bool = True,
) -> None:
    """Write ``df`` to ``path``; ``overwrite`` and ``append`` check the table's columns.

    ``keys`` are what a hidden ``bucket_of_<n>`` layout in ``partition_by`` hashes.
    ``gathered=False`` writes rows of partition folders from the tasks they are in, without a shuffle: for a
    batch of one folder or few, such as a day's load.

    An overwrite of a file table is written next to it and moved into place, so
    ``df`` may read the table it replaces, and a failed job leaves the table alone.  A
    second publish between the two moves is refused, and so is a move onto a table that
    appeared meanwhile; a reader between them finds no table.  Where that matters, or
    where a rename copies (object stores), use a transactional format.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    spark = df.sparkSession
    df = laid_out(df, partition_by, keys)
    present = table_exists(spark, path)
    if present and fmt in TYPED_FORMATS and (mode == "append" or not replace_schema):
        existing = _with_folders(spark, path, fmt).schema
        if mode == "append":
            df = _as_existing(df, existing, partition_by)
        elif _types(df.schema, partition_by) != _types(existing, partition_by):
            raise ValueError(
                "columns differ from the table; pass replace_schema=True to replace them"
            )

    writer = (_gathered(df, partition_by) if gathered else df).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    if mode == "append":
        writer.mode("append").save(path)
    elif fmt not in FILE_FORMATS:
        writer.mode("overwrite").option("overwriteSchema", replace_schema).save(path)
    else:
        staged = f"{path.rstrip('/')}.incoming-{uuid.uuid4().hex}"
        writer.save(staged)
        _keep_schema(df, staged, fmt, partition_by)
        if files.exists(spark, path):
            files.delete(spark, _previous(path))
            files.move(spark, path, _previous(path))
        files.move(spark, staged, path)
        files.delete(spark, _previous(path))


def replace_partitions(
    df: DataFrame, path: str, column: str, values: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Replace the partitions that ``df`` has rows for, and empty those of ``values`` that it has none for.

    Other partitions stay as they are.  Folders are committed one by one, as in
    :func:`upsert_table`; the same step run again puts a run right that was cut short.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        publish(df, path, "overwrite", fmt, partition_by=[column])
        return
    if fmt not in FILE_FORMATS:
        listed = ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
        where = f"CAST({column} AS STRING) IN ({listed})" if values else "true"
        _gathered(df, [column]).write.format(fmt).mode("overwrite").option("replaceWhere", where).save(path)
        return
    existing = _with_folders(spark, path, fmt)
    if set(df.columns) != set(existing.columns):
        raise ValueError(f"columns differ from the table: {sorted(set(df.columns) ^ set(existing.columns))}")
    rows, batch = stage(df)
    try:
        held = {str(r[0]) for r in rows.select(column).distinct().collect()} if values else set()
        _gathered(rows, [column]).write.format(fmt).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(column).save(path)
        for value in values:
            if value not in held:
                files.delete(spark, f"{path.rstrip('/')}/{column}={files.escaped_value(spark, value)}")
        _keep_schema(df, path, fmt, [column])
    finally:
        files.delete(spark, batch)


def replace_groups(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Replace all rows of the given ``groups`` (one row per key) by ``rows``; a group may be left with none.

    In a table of files that is laid out in buckets of the keys only the groups' buckets are read
    and written; a transactional table is overwritten in one commit.
    """
    if not table_exists(spark, path):
        publish(rows, path, "overwrite", fmt, partition_by=partition_by if fmt in FILE_FORMATS else (), keys=keys)
        return
    partition_by = layout_of(spark, path, fmt)
    new, batch = stage(laid_out(rows, partition_by, keys))
    named, folder = stage(laid_out(groups.select(*keys), partition_by, keys))
    try:
        target = _with_folders(spark, path, fmt, _typed_like(spark, path, fmt, named, partition_by))
        held = touched_rows(target, named, partition_by) if partition_by else target
        kept = lookup_join(held, named.select(*keys), keys, "left_anti")
        merged = kept.unionByName(new)
        if not partition_by:
            publish(merged, path, "overwrite", fmt)
            return
        merged, result = stage(merged)
        try:
            left = {r[0] for r in merged.select(*partition_by).distinct().collect()}
            _gathered(merged, partition_by).write.format(fmt).mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(*partition_by).save(path)
            for (bucket,) in named.select(*partition_by).distinct().collect():
                if bucket not in left:  # no row is left in this bucket
                    files.delete(spark, f"{path.rstrip('/')}/{partition_by[0]}={bucket}")
            _keep_schema(merged, path, fmt, partition_by)
        finally:
            files.delete(spark, result)
    finally:
        files.delete(spark, batch)
        files.delete(spark, folder)


def _typed_like(spark: SparkSession, path: str, fmt: str, df: DataFrame, partition_by: Sequence[str]) -> StructType | None:
    """The table's schema with the types of ``df`` for its folders' values."""
    return _with_types_of(df, _with_folders(spark, path, fmt).schema, partition_by) if partition_by else None


def _keep_schema(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str]) -> None:
    """Give a partitioned table without rows, which has no files, an empty one that says its columns."""
    spark = df.sparkSession
    if not partition_by or any(name.startswith(f"{partition_by[0]}=") for name in files.subfolders(spark, path)):
        return
    nowhere = "/".join(f"{c}={NULL_FOLDER}" for c in partition_by)
    inside = StructType([f for f in df.schema.fields if f.name not in partition_by])
    spark.createDataFrame([], inside).write.format(fmt).save(f"{path.rstrip('/')}/{nowhere}")


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together, so that it gets few, full files.

    Rebalancing splits a large folder over several tasks and joins small ones, where a
    plain write would make one file per task and folder.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def stage(df: DataFrame, purpose: str = "batch") -> tuple[DataFrame, str]:
    """``df`` computed once into the shared scratch folder, and that folder.

    Later steps then read it back instead of computing it again, also after an executor
    is lost, and the optimizer knows its size when it chooses the joins.
    """
    spark, folder = df.sparkSession, files.scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def at_once(spark: SparkSession, steps: Sequence[Callable[[], None]], fmt: str = "parquet") -> None:
    """Run steps on different tables side by side, so that tasks of one fill the cores that another leaves idle.

    All steps end before the first error is raised.  Tables of a transactional format go one after
    the other, as their MERGE reads a view of one name.
    """
    with ThreadPoolExecutor(len(steps) if fmt in FILE_FORMATS else 1) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            running.result()


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    check: bool = True,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    columns: ColumnMap | None = None,
    partitions_move: bool = True,
    stored: bool = False,
) -> None:
    """Create the table on the first write; later replace rows by key and add new ones.

    ``columns`` says what a match sets and what a new row gets, where replacing whole rows is not
    wanted; a new table takes the batch as it is.  ``merge`` combines (target, source) in any other
    way, and needs a table of files.

    With ``partition_by``, only the partitions that ``source`` touches are rewritten.  A
    batch that moves a row to another partition, or has NULL in a partition column,
    rewrites the whole table, which is exact in every case.  To tell, the keys of the
    whole table are read; not so where the partition columns are among the keys or hash
    them (``bucket_of_<n>``), or where the caller states that rows never change their partition
    (``partitions_move=False``).  A table that is laid out in hidden folders keeps its layout.
    The touched folders are committed one by one: a job that fails between them leaves some
    new and some old, and the same upsert run again puts that right.

    Where no key lies in two folders, ``columns`` are merged folder by folder, in one shuffle of the batch
    and the touched rows, and written as they lie.

    ``stored`` says that the batch is a plain selection from a stored table, other than ``path``,
    which is read again where needed and not staged.

    A table of a transactional format is merged by its own MERGE, with the same ``columns``.
    """
    if merge is not None and (columns is not None or fmt not in FILE_FORMATS):
        raise ValueError("merge is for tables of files, and in place of columns")
    if not table_exists(spark, path):
        publish(source, path, "overwrite", fmt, partition_by=partition_by, keys=keys)
        return
    source, batch = (source, None) if stored else stage(source)
    try:
        _upsert(spark, path, source, keys, fmt, partition_by, check, merge, columns, partitions_move)
    finally:
        if batch:
            files.delete(spark, batch)


def _merge_in_place(spark: SparkSession, source: DataFrame, statement: str) -> None:
    source.createOrReplaceTempView(MERGE_SOURCE)
    try:
        spark.sql(statement)
    finally:
        spark.catalog.dropTempView(MERGE_SOURCE)


def _upsert(spark, path, source, keys, fmt, partition_by, check, merge, columns, partitions_move) -> None:
    if fmt not in FILE_FORMATS:
        if check:
            require_single_match(read_table(spark, path, fmt), source, keys)
        maps = (columns.set, columns.values) if columns else ()
        _merge_in_place(spark, source, merge_statement(f"{fmt}.`{path}`", MERGE_SOURCE, keys, *maps))
        return
    partition_by = layout_of(spark, path, fmt) or partition_by
    source = laid_out(source, partition_by, keys)
    target = _with_folders(spark, path, fmt)
    if partition_by:
        # Directory names carry no types: read them with the types of the batch.
        target = _with_folders(spark, path, fmt, _with_types_of(source, target.schema, partition_by))
    if check:
        require_single_match(target, source, keys)
    if columns is not None:
        merge = lambda target, source: merge_cols(
            target, source, keys, columns.set, columns.values, once=bool(partition_by)
        )
    elif merge is None:
        merge = lambda target, source: merge_all(target, source, keys)
    if partition_by and not _moves(target, source, keys, partition_by, partitions_move):
        held = touched_rows(target, source, partition_by)
        by_folder = check and columns is not None and mergeable_in_place(target, source, [*keys, *partition_by])
        if by_folder and (_is_fixed(keys, partition_by) or _in_one_place(held, source, keys, partition_by)):
            shares = _shares(held, source, partition_by)
            merged = merge_cols_in_place(held, source, keys, columns.set, columns.values, partition_by, shares)
            ready = laid_out(merged, partition_by, keys)
        else:
            ready = _gathered(laid_out(merge(held, source), partition_by, keys), partition_by)
        ready.write.format(fmt).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*partition_by).save(path)
    else:
        publish(merge(target, source), path, "overwrite", fmt, partition_by=partition_by, keys=keys)


def _is_fixed(keys: Sequence[str], partition_by: Sequence[str]) -> bool:
    """Whether the keys alone say a row's partition."""
    return all(
        c in keys or BUCKETS.fullmatch(c) or (q := QUOTIENT.fullmatch(c)) and q[2] in keys for c in partition_by
    )


def _in_one_place(target: DataFrame, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> bool:
    """Whether no key lies in two folders of the rows at hand; by hashes, so that a chance hit says no."""
    both = target.select(*keys, *partition_by).unionByName(source.select(*keys, *partition_by)).dropna(subset=list(keys))
    places = both.select(F.xxhash64(*keys).alias("key"), F.xxhash64(*partition_by).alias("place"))
    return places.groupBy("key").agg(F.min("place").alias("low"), F.max("place").alias("high")).filter("low <> high").isEmpty()


def _shares(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> int:
    """In how many parts to merge the largest folder; a count per folder, which needs no other column."""
    places = target.select(*partition_by).unionByName(source.select(*partition_by))
    largest = places.groupBy(*partition_by).count().agg(F.max("count")).first()[0] or 0
    return -(-largest // ROWS_AT_ONCE) or 1


def _with_types_of(
    source: DataFrame, existing: StructType, columns: Sequence[str]
) -> StructType:
    return StructType([source.schema[f.name] if f.name in columns else f for f in existing.fields])


def touched_rows(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The target's rows in the partitions that ``source`` has rows for.

    The batch's buckets (as many as the layout has at most), or else its lowest and highest value
    per partition column, become a filter that the scan lists its folders by; where bounds do
    not say it all, a join makes the result exact.  Its other side has one row per folder, which the
    driver lists anyhow, so it is broadcast and the target is not shuffled.
    """
    if len(partition_by) == 1 and BUCKETS.fullmatch(partition_by[0]):
        touched = [r[0] for r in source.select(*partition_by).distinct().collect()]
        return target.filter(F.col(partition_by[0]).isin(touched))
    bounds = source.agg(
        *[f(c).alias(f"{c}{place}") for c in partition_by for place, f in ((0, F.min), (1, F.max))]
    ).first()
    for column in partition_by:
        target = target.filter(F.col(column).between(bounds[f"{column}0"], bounds[f"{column}1"]))
    return target.join(F.broadcast(source.select(*partition_by).distinct()), list(partition_by), "left_semi")


def _moves(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    partitions_move: bool = True,
) -> bool:
    """Whether a source row lacks a partition value or changes the one its key has."""
    no_partition = F.lit(False)
    for column in partition_by:
        no_partition = no_partition | F.col(column).isNull()
    if not source.filter(no_partition).isEmpty():
        return True
    if not partitions_move or _is_fixed(keys, partition_by):
        return False
    stays = F.lit(True)
    for column in partition_by:
        stays = stays & F.col(f"source.{column}").eqNullSafe(F.col(f"target.{column}"))
    same_key = [F.col(f"source.{k}") == F.col(f"target.{k}") for k in keys]
    located = list(dict.fromkeys([*keys, *partition_by]))
    pairs = target.select(*located).alias("target").join(
        source.select(*located).alias("source"), same_key
    )
    return not pairs.filter(~stays).isEmpty()


def landed(df: DataFrame, day, column: str = "ingestion_date") -> DataFrame:
    """One row: how many rows have ``day`` in the (partition) column, and if any do."""
    wanted = F.lit(day).cast("date")
    return (
        df.filter(F.col(column) == wanted)
        .agg(F.count(F.lit(1)).alias("rows_landed"))
        .select(wanted.alias("day"), "rows_landed", (F.col("rows_landed") > 0).alias("has_landed"))
    )
