"""Marketplace products: nested prices, item ids and category edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.dates import as_timestamp
from tillwater.functions.text import market_id
from tillwater.operators.keys import dedup_on
from tillwater.operators.shape import typed_nulls
from tillwater.sources.tables import replace_groups, upsert_table

# Fixed value: the brand of all marketplace products.
BRAND = "ebay"

# How new tables are laid out; large ones take more buckets.
LAYOUT = ("bucket_of_16",)

CATEGORY_LIST = "array<struct<categoryId:string>>"


def listed_products(items: DataFrame, as_of=None) -> DataFrame:
    """itemId, title and nested price as a product row."""
    return items.select(
        F.col("itemId").alias("product_id"),
        F.col("title").alias("product_name"),
        F.col("price.value").try_cast("double").alias("price"),
        F.lit(BRAND).alias("brand_name"),
        as_timestamp(as_of).alias("first_issue_date"),
    )


def shop_products(products: DataFrame) -> DataFrame:
    """One row per numeric product id, with the shop's columns."""
    rows = products.select(
        market_id("id").alias("product_id"),
        "product_name",
        "price",
        *typed_nulls({"description": "string", "img_link": "string"}),
        F.lit(BRAND).alias("product_brand"),
    )
    return dedup_on(rows, ["product_id"])


def shop_categories(categories: DataFrame) -> DataFrame:
    return categories.select(F.col("category_id").alias("id"), "category_name")


def category_edges(products: DataFrame) -> DataFrame:
    """(product_id, category_id) for each category in the JSON text; none for bad JSON."""
    parsed = F.from_json("categories", CATEGORY_LIST)
    return (
        products.select(market_id("id").alias("product_id"), F.explode(parsed).alias("category"))
        .select("product_id", F.col("category.categoryId").alias("category_id"))
        .filter(F.col("category_id").isNotNull())
    )


def refresh(spark: SparkSession, feed: DataFrame, path: str, fmt: str = "parquet", layout: Sequence[str] = LAYOUT) -> None:
    """Fold a feed (id, product_name, price, categories) into the products and the category edges.

    A product of the feed replaces its row and all its edges, so that a category it has left goes;
    other products keep theirs, and of the stored tables only the buckets of the feed's products are
    read and written.  Rows whose id is no number are left out.  The same feed again changes nothing.
    """
    known = feed.filter(market_id("id").isNotNull())
    upsert_table(spark, f"{path.rstrip('/')}/products", shop_products(known), ["product_id"], fmt, layout, check=False)
    products = known.select(market_id("id").alias("product_id")).distinct()
    replace_groups(
        spark, f"{path.rstrip('/')}/category_edges", category_edges(known).distinct(), products, ["product_id"], fmt, layout
    )
