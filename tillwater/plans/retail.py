"""Clients, products, stores and purchases: bronze to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.dates import days_before
from tillwater.functions.regions import region_of
from tillwater.operators.keys import latest, recent, require_columns, require_key
from tillwater.operators.upsert import same_named
from tillwater.sources.tables import FILE_FORMATS, ColumnMap, read_table, upsert_table

# A purchase row is one product of one transaction.
KEYS = {
    "clients": ["client_id"],
    "products": ["product_id"],
    "stores": ["store_id"],
    "purchases": ["transaction_id", "product_id"],
}

# Columns of the gold dimensions (fixed values).
GOLD_COLUMNS = {
    "clients": ["client_id", "first_issue_date", "first_redeem_date", "age", "gender"],
    "products": [
        "product_id", "level_1", "level_2", "level_3", "level_4", "brand_name",
        "product_name", "product_price", "first_issue_date",
    ],
    "stores": ["store_id", "store_name", "store_location", "region", "store_format", "first_issue_date"],
}

# How a new gold dimension is laid out; a large one takes more buckets.
GOLD_LAYOUT = ("bucket_of_16",)

BRONZE_HELPERS = ("source_file", "ingestion_time", "ingestion_date")
RECENT_DAYS = 7


def silver_rows(
    bronze: DataFrame, keys: Sequence[str], as_of, days: int = RECENT_DAYS, keep_day: bool = False
) -> DataFrame:
    """The newest version per key among the rows of the last ``days`` days.

    ``keep_day`` adds ``ingestion_date``, by which later steps find what a run changed.
    """
    require_columns(bronze, [*keys, "ingestion_time"])
    if "ingestion_date" in bronze.columns:
        bronze = bronze.filter(F.col("ingestion_date") >= F.to_date(days_before(as_of, days)))
    rows = recent(bronze, "ingestion_time", days, as_of)
    if not keep_day:
        return latest(rows, keys, "ingestion_time", BRONZE_HELPERS)
    newest = latest(rows, keys, "ingestion_time", [c for c in BRONZE_HELPERS if c != "ingestion_time"])
    return newest.withColumn("ingestion_date", F.to_date("ingestion_time")).drop("ingestion_time")


def changed_since(silver: DataFrame, since) -> DataFrame:
    """The silver rows that came in on ``since`` or later, by a filter the scan can use; all for None."""
    return silver if since is None else silver.filter(F.col("ingestion_date") >= F.lit(since).cast("date"))


def refresh_silver(
    spark: SparkSession,
    table: str,
    bronze_path: str,
    silver_path: str,
    as_of=None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keys: Sequence[str] | None = None,
) -> None:
    keys = keys or KEYS[table]
    rows = silver_rows(read_table(spark, bronze_path, fmt), keys, as_of, keep_day=True)
    # One row per key by construction: no need to look for repeated keys.
    upsert_table(spark, silver_path, rows, keys, fmt, partition_by, check=False)


def described_stores(stores: DataFrame) -> DataFrame:
    """Stores with the region their location lies in."""
    return stores.withColumn("region", region_of("store_location"))


def gold_rows(silver: DataFrame, table: str) -> DataFrame:
    return require_key(silver.select(*GOLD_COLUMNS[table]), KEYS[table][0])


def gold_map(table: str) -> ColumnMap:
    """Update every gold column but the key; a new row takes all of them."""
    columns = GOLD_COLUMNS[table]
    return ColumnMap(same_named([c for c in columns if c not in KEYS[table]]), same_named(columns))


def refresh_gold(
    spark: SparkSession,
    table: str,
    silver_path: str,
    gold_path: str,
    fmt: str = "parquet",
    since=None,
    partition_by: Sequence[str] = GOLD_LAYOUT,
) -> None:
    """Fold the silver rows that came in since the day of the last run (all for None) into gold.

    A table of files is laid out in buckets of the key, and a run rewrites those that its rows fall
    in; a transactional table is merged in place.
    """
    rows = gold_rows(changed_since(read_table(spark, silver_path, fmt), since), table)
    upsert_table(
        spark, gold_path, rows, KEYS[table], fmt, partition_by if fmt in FILE_FORMATS else (), columns=gold_map(table)
    )
