"""Retail layers: latest rows, upserts, dimensions, facts and the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwater.operators.aggregates import high_water
from tillwater.operators.keys import dedup_on, recent
from tillwater.operators.upsert import merge_all, merge_cols, require_single_match
from tillwater.plans import calendar, retail, sales
from tillwater.sources.files import scratch_folder
from tillwater.sources.tables import publish, read_table, stage
from workload import duck
from workload.registry import query
from workload.standins import ctes, frame

# A week before this day starts the recency window of the bronze tables.
AS_OF = "1998-06-08"
WINDOW_START = "TIMESTAMP '1998-06-01'"

FACTS = """SELECT p.transaction_id, p.product_id, p.client_id, p.store_id,
    CAST(strftime(p.transaction_datetime, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(p.transaction_datetime AS DATE) AS transaction_datetime,
    CAST(trunc(p.product_quantity) AS INTEGER) AS product_quantity,
    d.product_price AS unit_price,
    d.product_price * trunc(p.product_quantity) * CAST(0.05 AS DOUBLE) AS discount_amount,
    d.product_price * trunc(p.product_quantity)
      - d.product_price * trunc(p.product_quantity) * CAST(0.05 AS DOUBLE) AS purchase_sum,
    p.regular_points_received, 'POS' AS payment_method
  FROM purchases p LEFT JOIN products d ON p.product_id = d.product_id"""


@query(ctes("purchases", "products") + FACTS)
def fact_sales_init(spark, sf_dir):
    return sales.initial_facts(frame(spark, sf_dir, "purchases"), frame(spark, sf_dir, "products"))


def _newest(name: str, keys: str, rest: str) -> str:
    """The newest row per key of a bronze stand-in inside the recency window."""
    columns = ", ".join([*keys.split(", "), *rest.split(", ")])
    order = ", ".join(
        ["ingestion_time DESC NULLS LAST", *[f"{c} ASC NULLS LAST" for c in [*rest.split(", "), "source_file"]]]
    )
    return duck.first_row(
        columns, f"(SELECT * FROM {name} WHERE ingestion_time >= {WINDOW_START})", keys, order
    )


PURCHASE_REST = (
    "client_id, transaction_datetime, regular_points_received, purchase_sum, store_id, product_quantity"
)
PURCHASE_COLUMNS = f"transaction_id, product_id, {PURCHASE_REST}"
NEW_PURCHASES = _newest("bronze_purchases", "transaction_id, product_id", PURCHASE_REST)
NEW_CLIENTS = _newest(
    "bronze_clients", "client_id",
    "first_issue_date, first_redeem_date, age, gender, first_name, middle_name, last_name",
)
PRODUCT_REST = (
    "level_1, level_2, level_3, level_4, brand_name, product_name, product_price, first_issue_date"
)
NEW_PRODUCTS = _newest("bronze_products", "product_id", PRODUCT_REST)
STORE_REST = "store_name, store_location, region, store_format, first_issue_date"
NEW_STORES = _newest("bronze_stores", "store_id", STORE_REST)


def _batch(spark, sf_dir, table):
    return retail.silver_rows(frame(spark, sf_dir, f"bronze_{table}"), retail.KEYS[table], AS_OF)


@query(ctes("bronze_purchases", rows=NEW_PURCHASES) + f"SELECT {PURCHASE_COLUMNS} FROM rows")
def latest_per_key(spark, sf_dir):
    return _batch(spark, sf_dir, "purchases")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS shipped
    FROM lineitem WHERE l_shipdate >= {WINDOW_START}""")
def recent_filter(spark, sf_dir):
    rows = recent(frame(spark, sf_dir, "lineitem"), "l_shipdate", retail.RECENT_DAYS, AS_OF)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("shipped")
    )


@query(duck.first_row(
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS shipped",
    "lineitem", "l_orderkey, l_linenumber",
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
    "l_linestatus, l_shipdate",
))
def dedup_key(spark, sf_dir):
    rows = dedup_on(frame(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )


def _merged(existing: str, columns: str, keys: list[str]) -> str:
    same = " AND ".join(f"r.{k} = e.{k}" for k in keys)
    return f"""SELECT {columns} FROM rows UNION ALL
        SELECT {columns} FROM {existing} e WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE {same})"""


def _silver(spark, sf_dir, table, existing):
    # One row per key by construction, so repeated keys need no check.
    batch, _ = stage(_batch(spark, sf_dir, table))
    return merge_all(frame(spark, sf_dir, existing), batch, retail.KEYS[table])


CLIENT_COLUMNS = (
    "client_id, first_issue_date, first_redeem_date, age, gender, first_name, middle_name, last_name"
)


@query(ctes("bronze_clients", "clients", rows=NEW_CLIENTS) + _merged("clients", CLIENT_COLUMNS, ["client_id"]))
def silver_client(spark, sf_dir):
    return _silver(spark, sf_dir, "clients", "clients")


@query(ctes("bronze_products", "gold_products", rows=NEW_PRODUCTS)
       + _merged("gold_products", f"product_id, {PRODUCT_REST}", ["product_id"]))
def silver_product(spark, sf_dir):
    return _silver(spark, sf_dir, "products", "gold_products")


@query(ctes("bronze_stores", "gold_stores", rows=NEW_STORES)
       + _merged("gold_stores", f"store_id, {STORE_REST}", ["store_id"]))
def silver_store(spark, sf_dir):
    return _silver(spark, sf_dir, "stores", "gold_stores")


@query(ctes("bronze_purchases", "silver_purchases", rows=NEW_PURCHASES)
       + _merged("silver_purchases", PURCHASE_COLUMNS, ["transaction_id", "product_id"]))
def silver_purchase(spark, sf_dir):
    return _silver(spark, sf_dir, "purchases", "silver_purchases")


# Two versions of every part: the target holds the even keys (NULL on some), the
# source the keys up to the same number, with other prices.
TARGET = """SELECT CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_partkey * 2 END AS part_id,
    p_name AS name, p_retailprice AS price, p_brand AS brand FROM part"""
SOURCE = """SELECT CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_partkey END AS part_id,
    upper(p_name) AS name, p_retailprice * 3 AS price, p_type AS brand FROM part"""


def _part_versions(spark, sf_dir):
    part = frame(spark, sf_dir, "part")
    return spark.sql(TARGET.replace("FROM part", "FROM {part}"), part=part), spark.sql(
        SOURCE.replace("FROM part", "FROM {part}"), part=part
    )


@query(f"""WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT * FROM s UNION ALL
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.part_id = t.part_id)""", name="merge_all")
def merge_all_rows(spark, sf_dir):
    target, source = _part_versions(spark, sf_dir)
    require_single_match(target, source, ["part_id"])
    return merge_all(target, source, ["part_id"])


@query(f"""WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT coalesce(t.part_id, s.part_id) AS part_id,
           CASE WHEN t.here THEN t.name ELSE s.name END AS name,
           CASE WHEN s.here AND t.here THEN t.price + s.price WHEN t.here THEN t.price ELSE s.price END AS price,
           t.brand AS brand
    FROM (SELECT *, true AS here FROM t) t FULL JOIN (SELECT *, true AS here FROM s) s
      ON t.part_id = s.part_id""", name="merge_cols")
def merge_cols_rows(spark, sf_dir):
    """The price grows on a match; a new row has no brand."""
    target, source = _part_versions(spark, sf_dir)
    require_single_match(target, source, ["part_id"])
    return merge_cols(
        target, source, ["part_id"],
        set={"price": "target.price + source.price"},
        values={"part_id": "source.part_id", "name": "source.name", "price": "source.price"},
    )


def _gold(existing: str, batch: str, columns: str, key: str) -> str:
    return f"""SELECT {columns} FROM {batch} WHERE {key} IS NOT NULL UNION ALL
        SELECT {columns} FROM {existing} e
        WHERE NOT EXISTS (SELECT 1 FROM {batch} b WHERE b.{key} = e.{key})"""


def _gold_twice(spark, sf_dir, table, late):
    """Gold after two runs on stored tables: the rows of the first week, then those that came in since.

    ``late``: which silver rows came in with the second run.
    """
    folder = scratch_folder(spark, f"gold-{table}")
    silver, gold = f"{folder}/silver", f"{folder}/gold"
    day = F.when(late, F.lit("2024-01-08")).otherwise(F.lit("2024-01-01")).cast("date")
    rows = frame(spark, sf_dir, table).withColumn("ingestion_date", day)
    publish(frame(spark, sf_dir, f"gold_{table}"), gold, partition_by=["bucket_of_8"], keys=retail.KEYS[table])
    publish(rows.filter("ingestion_date < '2024-01-08'"), silver)
    retail.refresh_gold(spark, table, silver, gold)
    publish(rows, silver)
    retail.refresh_gold(spark, table, silver, gold, since="2024-01-08")
    return read_table(spark, gold)


@query(ctes("gold_clients", "clients") + _gold(
    "gold_clients", "clients", "client_id, first_issue_date, first_redeem_date, age, gender", "client_id"))
def gold_client(spark, sf_dir):
    return _gold_twice(spark, sf_dir, "clients", F.col("first_redeem_date").isNull())


@query(ctes("gold_products", "products") + _gold(
    "gold_products", "products", f"product_id, {PRODUCT_REST}", "product_id"))
def gold_product(spark, sf_dir):
    return _gold_twice(spark, sf_dir, "products", F.col("first_issue_date") >= "2018-07-01")


@query(ctes("gold_stores", "stores") + _gold("gold_stores", "stores", f"store_id, {STORE_REST}", "store_id"))
def gold_store(spark, sf_dir):
    return _gold_twice(spark, sf_dir, "stores", F.col("store_format") == "Supermarket")


NEW_COLUMNS = """r.client_id, r.store_id,
    CAST(strftime(r.transaction_datetime, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(r.transaction_datetime AS DATE) AS transaction_datetime, r.product_quantity,
    CASE WHEN r.product_quantity <> 0 THEN r.purchase_sum / r.product_quantity END AS unit_price,
    CAST(0 AS DOUBLE) AS discount_amount, r.purchase_sum, r.regular_points_received"""
SAME_LINE = "r.transaction_id = f.transaction_id AND r.product_id = f.product_id"


@query(ctes("purchases", "products", "bronze_purchases", rows=NEW_PURCHASES, facts=FACTS) + f"""
    SELECT r.transaction_id, r.product_id, {NEW_COLUMNS}, f.payment_method
    FROM rows r LEFT JOIN facts f ON {SAME_LINE}
    UNION ALL
    SELECT * REPLACE (CAST(product_quantity AS DOUBLE) AS product_quantity) FROM facts f
    WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE {SAME_LINE})""")
def fact_sales_incr(spark, sf_dir):
    """The newest purchases folded into stored facts of the first build, by month; all facts of a line change."""
    folder = scratch_folder(spark, "facts")
    silver, facts = f"{folder}/silver", f"{folder}/facts"
    built = sales.initial_facts(frame(spark, sf_dir, "purchases"), frame(spark, sf_dir, "products"))
    publish(
        built.withColumn("product_quantity", F.col("product_quantity").cast("double")), facts,
        partition_by=["div_100_of_date_key"],
    )
    bronze = frame(spark, sf_dir, "bronze_purchases")
    rows = retail.silver_rows(bronze, retail.KEYS["purchases"], AS_OF, keep_day=True)
    publish(rows, silver)
    # a purchase line keeps its day, and silver holds one row per line
    sales.refresh_facts(spark, silver, facts, since="1998-06-01", partitions_move=False)
    return read_table(spark, facts)


ORDER_SPAN = """SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
    FROM orders"""


@query(f"""WITH span AS ({ORDER_SPAN}), days AS (
        SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
    SELECT {duck.calendar('d')} FROM days""")
def dim_time(spark, sf_dir):
    """The calendar from the first to the last order."""
    bounds = frame(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("start_date"),
        F.max("o_orderdate").cast("date").alias("end_date"),
    )
    return calendar.date_dimension(bounds)


@query(f"""WITH known AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
    days AS (SELECT CAST(unnest(generate_series(
        (SELECT max(d) + 1 FROM known), DATE '2002-02-03', INTERVAL 1 DAY)) AS DATE) AS d)
    SELECT {duck.calendar('d')} FROM days WHERE d NOT IN (SELECT d FROM known)""")
def dim_time_incr(spark, sf_dir):
    """The days after the last order up to a later date."""
    known = frame(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return calendar.missing_dates(known.select(*calendar.calendar_columns("full_date")), "2002-02-03")


@query("SELECT CAST(max(l_shipdate) AS DATE) AS l_shipdate FROM lineitem")
def high_water_mark(spark, sf_dir):
    return high_water(frame(spark, sf_dir, "lineitem"), "l_shipdate").select(
        F.col("l_shipdate").cast("date").alias("l_shipdate")
    )
