"""First loads of CSV files and appends of raw CSV folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.dates import as_timestamp
from tillwater.sources.csv import read_csv, read_folder
from tillwater.sources.tables import publish

# Tables whose first load stamps the time they were first issued.
STAMPED_TABLES = ("products", "stores", "reviews")


def first_load(df: DataFrame, stamp: bool, as_of=None) -> DataFrame:
    return df.withColumn("first_issue_date", as_timestamp(as_of)) if stamp else df


def load_csv(
    spark: SparkSession, table: str, csv_path: str, path: str, fmt: str = "parquet", as_of=None
) -> None:
    """CSV with inferred types to a table, replacing its rows and its columns."""
    rows = first_load(read_csv(spark, csv_path), table in STAMPED_TABLES, as_of)
    publish(rows, path, "overwrite", fmt, replace_schema=True)


def ingest_folder(
    spark: SparkSession, folder: str, path: str, fmt: str = "parquet", as_of=None, by_day: bool = False
) -> None:
    """Append all CSV files of a folder, as strings with provenance, to a bronze table.

    ``by_day`` adds an ingestion_date partition, so that the weekly scan of the next
    layer lists only the days it needs.
    """
    rows = read_folder(spark, folder, as_of)
    if by_day:
        rows = rows.withColumn("ingestion_date", F.to_date("ingestion_time"))
    publish(rows, path, "append", fmt, partition_by=("ingestion_date",) if by_day else ())
