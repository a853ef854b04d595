"""The product stream, fed from files of JSON messages made from the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwater.sources.files import scratch_folder
from tillwater.streaming import products
from workload.registry import query
from workload.standins import frame


def _messages(spark, sf_dir):
    """A message per part: whole category lists, short ones, none; every seventh is junk."""
    part = frame(spark, sf_dir, "part")
    key = F.col("p_partkey")
    ids = F.when(key % 3 == 0, F.array(F.col("p_size"), F.lit(7), F.lit(8), F.lit(9), F.lit(10))).when(
        key % 3 == 1, F.array("p_size")
    )
    message = F.to_json(
        F.struct(
            key.cast("int").alias("productId"),
            F.col("p_name").alias("ProductName"),
            F.col("p_brand").alias("brandName"),
            F.col("p_type").alias("Description"),
            F.col("p_size").cast("float").alias("Price"),
            ids.alias("categoryIds"),
        )
    )
    return part.select(
        F.when(key % 7 == 0, F.concat(F.lit("junk "), key.cast("string"))).otherwise(message).alias("value")
    )


def _run(spark, sf_dir):
    base = scratch_folder(spark, "stream")
    _messages(spark, sf_dir).write.text(f"{base}/in")
    source = products.read_message_files(spark, f"{base}/in")
    products.listen(source, f"{base}/products", f"{base}/bad", f"{base}/checkpoints", drain=True)
    return base


@query("""SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_partkey % 3 < 2 THEN CAST(p_size AS VARCHAR) END AS level_1,
    CASE WHEN p_partkey % 3 = 0 THEN '7' END AS level_2, CASE WHEN p_partkey % 3 = 0 THEN '8' END AS level_3,
    CASE WHEN p_partkey % 3 = 0 THEN '9' END AS level_4,
    p_brand AS brand_name, p_name AS product_name, CAST(p_size AS DOUBLE) AS product_price
    FROM part WHERE p_partkey % 7 <> 0""")
def stream_products(spark, sf_dir):
    """The typed rows that a drained stream has written."""
    rows = spark.read.parquet(f"{_run(spark, sf_dir)}/products")
    return products.bronze_products(rows).drop("first_issue_date")


@query("""SELECT 'junk ' || p_partkey AS message FROM part WHERE p_partkey % 7 = 0""")
def stream_quarantine(spark, sf_dir):
    """The messages that do not fit, unchanged."""
    return spark.read.parquet(f"{_run(spark, sf_dir)}/bad").select("message")
