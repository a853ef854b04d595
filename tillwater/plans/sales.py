"""The sales fact table: first build from list prices, later batches from paid sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.dates import date_key
from tillwater.operators.upsert import same_named
from tillwater.plans.retail import KEYS, changed_since
from tillwater.sources.tables import ColumnMap, publish, read_table, upsert_table

# Fixed values of the first build.
DISCOUNT_RATE = 0.05
PAYMENT_METHOD = "POS"

INITIAL_COLUMNS = [
    "transaction_id", "product_id", "client_id", "store_id", "date_key",
    "transaction_datetime", "product_quantity", "unit_price", "discount_amount",
    "purchase_sum", "regular_points_received", "payment_method",
]

INCREMENT_COLUMNS = [
    "product_id", "client_id", "transaction_id", "transaction_datetime", "date_key",
    "product_quantity", "unit_price", "discount_amount", "purchase_sum",
    "regular_points_received", "store_id",
]

FACT_KEYS = KEYS["purchases"]


def initial_facts(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Price, discount and sum of each purchase line from the product's list price.

    Only two product columns enter the join, as its right side: the optimizer
    broadcasts them within its size limit and otherwise can split a hot product.
    """
    prices = products.select("product_id", F.col("product_price").alias("unit_price"))
    gross = F.col("unit_price") * F.col("product_quantity")
    return (
        purchases.select(
            "transaction_id",
            "product_id",
            F.col("client_id").cast("string").alias("client_id"),
            F.col("store_id").cast("string").alias("store_id"),
            F.to_date("transaction_datetime").alias("transaction_datetime"),
            F.col("product_quantity").try_cast("int").alias("product_quantity"),
            "regular_points_received",
        )
        .join(prices, "product_id", "left")
        .withColumn("date_key", date_key("transaction_datetime"))
        .withColumn("discount_amount", gross * F.lit(DISCOUNT_RATE))
        .withColumn("purchase_sum", gross - F.col("discount_amount"))
        .withColumn("payment_method", F.lit(PAYMENT_METHOD))
        .select(*INITIAL_COLUMNS)
    )


def increment_facts(purchases: DataFrame) -> DataFrame:
    """No discount; the unit price is what was paid per piece, NULL for quantity 0 or NULL."""
    return purchases.withColumns(
        {
            "transaction_datetime": F.to_date("transaction_datetime"),
            "date_key": date_key("transaction_datetime"),
            "unit_price": F.try_divide("purchase_sum", "product_quantity"),
            "discount_amount": F.lit(0.0),
        }
    ).select(*INCREMENT_COLUMNS)


def fact_map(keys: Sequence[str] = FACT_KEYS) -> ColumnMap:
    """Every column of the batch; one that only the first build has keeps its value, NULL on new rows."""
    return ColumnMap(same_named([c for c in INCREMENT_COLUMNS if c not in keys]), same_named(INCREMENT_COLUMNS))


def refresh_facts(
    spark: SparkSession,
    silver_path: str,
    facts_path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keys: Sequence[str] = FACT_KEYS,
    since=None,
    partitions_move: bool = True,
) -> None:
    """Fold the silver purchases that came in since the day of the last run into the facts.

    Partitioned facts rewrite touched partitions only, such as ``div_100_of_date_key`` for the months.
    With the partition column among the keys, or ``partitions_move=False`` (a purchase line keeps
    its day), the other partitions are not read either, and the touched ones once.  A
    transactional table is merged in place.
    """
    batch = increment_facts(changed_since(read_table(spark, silver_path, fmt), since))
    upsert_table(
        spark, facts_path, batch, keys, fmt, partition_by, columns=fact_map(keys), partitions_move=partitions_move,
        stored=True,
    )


def build_warehouse(
    clients: DataFrame,
    products: DataFrame,
    purchases: DataFrame,
    stores: DataFrame,
    dim_times: DataFrame,
    path: str,
    fmt: str = "parquet",
) -> None:
    """First build of the star: facts, date dimension and the three other dimensions."""
    tables = {
        "fact_sales": initial_facts(purchases, products),
        "dim_times": dim_times,
        "clients": clients,
        "products": products,
        "stores": stores,
    }
    for name, rows in tables.items():
        publish(rows, f"{path.rstrip('/')}/{name}", "overwrite", fmt)
