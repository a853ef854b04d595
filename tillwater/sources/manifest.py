"""Which parts of a table earlier runs have folded in.

A part is a folder ``column=value`` of a partitioned table, such as a day that rows came in; a table
without such folders is one part.  A part's mark (files, bytes, time of the last change) tells
whether it is as a run has left it, so that a late file makes its day new again.  Marks are
written after a run's tables, which must take the same rows twice: a run that was cut short is
repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.sources import files
from tillwater.sources.tables import NULL_FOLDER, publish, read_table, table_exists

WHOLE = ""
# The mark of a part that was folded in and is not there any more.
GONE = "gone"


def parts(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Value -> mark of each part of a table; none where there is no table."""
    if not files.exists(spark, path):
        return {}
    found = {}
    for name in files.subfolders(spark, path):
        if name.startswith(f"{column}="):
            found[unquote(name.partition("=")[2])] = files.mark(spark, f"{path.rstrip('/')}/{name}")
    return found or {WHOLE: files.mark(spark, path)}


def pending(spark: SparkSession, manifest: str, source: str, path: str, column: str) -> dict[str, str]:
    """The parts of the table at ``path`` that the manifest does not hold as they are now, also those that went."""
    known = {}
    if table_exists(spark, manifest):
        known = {r.part: r.mark for r in read_table(spark, manifest).filter(F.col("source") == source).collect()}
    now = dict.fromkeys(known, GONE) | parts(spark, path, column)
    return {part: mark for part, mark in now.items() if known.get(part) != mark}


def chosen(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """The rows of the given parts, by a filter that the scan lists its folders by."""
    if WHOLE in values:
        return df
    wanted = F.col(column).cast("string").isin([v for v in values if v != NULL_FOLDER])
    return df.filter(wanted | F.col(column).isNull() if NULL_FOLDER in values else wanted)


def record(spark: SparkSession, manifest: str, folded: Mapping[str, Mapping[str, str]]) -> None:
    """Note the parts of each source as folded in."""
    known = {}
    if table_exists(spark, manifest):
        known = {(r.source, r.part): r.mark for r in read_table(spark, manifest).collect()}
    known |= {(source, part): mark for source, marks in folded.items() for part, mark in marks.items()}
    rows = [(*place, mark) for place, mark in sorted(known.items())]
    publish(spark.createDataFrame(rows, "source string, part string, mark string").coalesce(1), manifest)
