"""CSV scans, folder ingest with provenance, and CSV export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwater.functions.dates import as_timestamp
from tillwater.sources import files


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    infer: bool = True,
    schema: StructType | None = None,
    **options,
) -> DataFrame:
    """CSV with a header: an explicit schema, inferred types, or all strings.

    Inferring reads the files once more; name a schema for large inputs.
    """
    reader = spark.read.options(header=True, **options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.csv(path, inferSchema=infer)


def with_provenance(df: DataFrame, as_of=None) -> DataFrame:
    """Add ingestion_time and source_file to a frame read straight from files."""
    return df.withColumns(
        {"ingestion_time": as_timestamp(as_of), "source_file": F.col("_metadata.file_path")}
    )


def platform_name() -> Column:
    """Text before the first dash of the file a row came from."""
    return F.substring_index(F.col("_metadata.file_name"), "-", 1)


def with_platform(df: DataFrame) -> DataFrame:
    return df.withColumn("platform", platform_name())


def read_folder(spark: SparkSession, folder: str, as_of=None) -> DataFrame:
    """All CSV files of a folder in one parallel scan, as strings with provenance.

    ``enforceSchema=False`` fails on a file whose header differs from the others,
    where a positional read would put values into the wrong columns.
    """
    raw = read_csv(spark, f"{folder.rstrip('/')}/*.csv", infer=False, enforceSchema=False)
    return with_provenance(raw, as_of)


def read_by_header(spark: SparkSession, paths: str | Sequence[str]) -> list[DataFrame]:
    """CSV files as strings, one scan for all files of one header line.

    A scan takes its columns from one header, so files whose columns stand in another order, or are
    others, need a scan of their own; the caller aligns them by name.  Empty files give nothing.
    """
    found = [f for p in ([paths] if isinstance(paths, str) else paths) for f in files.expand(spark, p)]
    by_header: dict[str, list[str]] = {}
    for path, header in zip(found, files.first_lines(spark, found)):
        if header is not None:
            by_header.setdefault(header.removeprefix("\ufeff"), []).append(files.as_pattern(path))
    return [read_csv(spark, same, infer=False) for same in by_header.values()]


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header: parallel part files, or one file where the caller asks for it.

    One file is written by one task, which suits a summary.
    """
    rows = df.coalesce(1) if single_file else df
    rows.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).mode("overwrite").csv(path)
