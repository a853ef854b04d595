"""Time the headline queries: prints one JSON line.

Each query is computed in full (``noop`` sink) after one warm-up run of the session;
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores, ``BENCH_QUERIES`` a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from workload import QUERIES

HEADLINE = [
    "fact_sales_init", "fact_sales_incr", "latest_per_key", "silver_purchase", "silver_client",
    "gold_client", "merge_all", "merge_cols", "dim_time", "dedup_key",
    "social_users", "social_posts", "mentions", "platform_users", "platform_posts", "post_hashtag",
    "hashtag_usage", "user_mention", "repair_instagram", "repair_twitter", "repair_tiktok",
    "hashtag_list", "region_lookup", "conform_schema", "csv_infer", "bronze_ingest",
    "write_roundtrip", "upsert_first_write", "stream_products",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{os.getcwd()}/spark-warehouse/_scratch")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(cpus)
    QUERIES["fact_sales_init"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
