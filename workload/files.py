"""Files: CSV scans, folder ingest, table writes, exports and nested Parquet.

Each query writes a given table to a new folder under the shared scratch folder,
reads it back through the operator and drops the clock and path columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwater.operators.keys import dedup_on
from tillwater.operators.shape import align_union, conform
from tillwater.plans import loads, marketplace, retail, social_entities
from tillwater.sources.csv import export_csv, read_csv, read_folder
from tillwater.sources.files import scratch_folder
from tillwater.sources.schemas import PRODUCTS, SILVER_USER, TIKTOK_COMMENTS
from tillwater.sources.tables import landed, publish, read_table, upsert_table
from workload import duck
from workload.registry import query
from workload.standins import ctes, frame

LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag"
)


@query("""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
    o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
    'POS' AS channel FROM orders""")
def csv_infer(spark, sf_dir):
    """First load: inferred types, an issue stamp, one overwrite."""
    folder = scratch_folder(spark, "csv-infer")
    orders = frame(spark, sf_dir, "orders").withColumn("channel", F.lit("POS"))
    orders.write.option("header", True).csv(f"{folder}/csv")
    loads.load_csv(spark, "reviews", f"{folder}/csv", f"{folder}/table", as_of="2024-01-01")
    table = read_table(spark, f"{folder}/table")
    return table.drop("first_issue_date").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query(ctes("clients") + "SELECT *, 'clients' AS source FROM clients")
def bronze_ingest(spark, sf_dir):
    """Raw CSV folder to bronze: strings, provenance, append."""
    folder = scratch_folder(spark, "bronze")
    clients = frame(spark, sf_dir, "clients")
    clients.repartition(4, "client_id").write.option("header", True).csv(f"{folder}/clients")
    loads.ingest_folder(spark, f"{folder}/clients", f"{folder}/bronze", as_of="2024-01-01", by_day=True)
    bronze = read_table(spark, f"{folder}/bronze")
    source = F.regexp_extract("source_file", "/([^/]+)/[^/]+$", 1)
    return bronze.select(*clients.columns, source.alias("source"))


@query(ctes("tiktok") + "SELECT * REPLACE (nullif(num_likes, '') AS num_likes, "
       "nullif(commenter_url, '') AS commenter_url) FROM tiktok")
def csv_schema(spark, sf_dir):
    """A CSV scan with a given schema; an empty text comes back as NULL."""
    rows = frame(spark, sf_dir, "tiktok")
    folder = scratch_folder(spark, "csv-schema")
    rows.write.options(
        header=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    return read_csv(spark, folder, schema=TIKTOK_COMMENTS)


@query("""SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type AS platform FROM events""")
def platform_from_file(spark, sf_dir):
    """The platform from the file name: a folder of files per event type, loaded as social entities.

    Each event is a user of its own, whose name holds the event's values.  A platform's files have
    their columns in two orders.
    """
    events = frame(spark, sf_dir, "events")
    folder = scratch_folder(spark, "platforms")
    values = [F.coalesce(c.cast("string"), F.lit("")) for c in (F.col("event_id"), F.col("user_id"), F.to_date("ts"))]
    name = F.concat_ws("_", *values)
    rows = events.select(
        F.concat(F.lit("u/"), name).alias("user_url"), F.concat(F.lit("p/"), name).alias("post_url"), "event_type", "value"
    )
    orders = {"first": (["user_url", "post_url"], "value < 50"), "other": (["post_url", "user_url"], "NOT value < 50 OR value IS NULL")}
    for order, (columns, part) in orders.items():
        rows.filter(part).select(*columns, "event_type").write.partitionBy("event_type").option("header", True).csv(f"{folder}/{order}")
    _name_files_by_platform(spark, folder)
    social_entities.load_entities(spark, f"{folder}/named", f"{folder}/bronze", as_of="2024-01-01")
    value = F.split("display_name", "_")
    return read_table(spark, f"{folder}/bronze/dim_users").select(
        value[0].try_cast("bigint").alias("event_id"), value[1].try_cast("bigint").alias("user_id"),
        value[2].try_cast("date").alias("day"), F.col("type_of_account").alias("platform"),
    )


def _name_files_by_platform(spark, folder):
    """Move part files to ``<platform>-<n>.csv``, the naming the operator reads."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(f"{folder}/named"))
    for number, part in enumerate(fs.globStatus(hadoop.Path(f"{folder}/*/event_type=*/part-*"))):
        platform = part.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(part.getPath(), hadoop.Path(f"{folder}/named/{platform}-{number}.csv"))


@query("""SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price,
    'ebay' AS brand_name FROM part""")
def struct_price(spark, sf_dir):
    """Nested prices from Parquet: field extract, cast, rename, constant brand."""
    folder = scratch_folder(spark, "nested")
    frame(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("itemId"),
        F.col("p_name").alias("title"),
        F.struct(F.col("p_retailprice").cast("string").alias("value"), F.lit("USD").alias("currency")).alias("price"),
    ).write.parquet(folder)
    items = read_table(spark, folder)
    return marketplace.listed_products(items, "2024-01-01").drop("first_issue_date")


@query(f"SELECT {LINE_COLUMNS}, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def write_roundtrip(spark, sf_dir):
    """Overwrite, then overwrite with another set of columns from the table itself."""
    path = scratch_folder(spark, "roundtrip")
    publish(frame(spark, sf_dir, "lineitem"), path)
    publish(
        read_table(spark, path).select(
            *LINE_COLUMNS.split(", "), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")
        ),
        path,
        replace_schema=True,
    )
    return read_table(spark, path)


@query("""SELECT 'u' || user_id AS user_id, min(event_type) AS user_type FROM events GROUP BY user_id
    UNION ALL SELECT 'c' || c_custkey, CAST(NULL AS VARCHAR) FROM customer""")
def append_align(spark, sf_dir):
    """Append seven columns to a table of eight: the missing one is NULL."""
    path = scratch_folder(spark, "append")
    eight = frame(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id")
    ).agg(F.min("event_type").alias("user_type"))
    seven = frame(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("c_name").alias("display_name"),
    )
    layout = conform(seven, SILVER_USER).drop("user_type")
    publish(conform(eight, SILVER_USER), path)
    publish(layout, path, "append")
    return read_table(spark, path).select("user_id", "user_type")


@query(ctes("gold_products", "products") + """
    SELECT * FROM products UNION ALL
    SELECT * FROM gold_products g WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = g.product_id)""")
def upsert_first_write(spark, sf_dir):
    """Created on the first write, merged on the second."""
    path = scratch_folder(spark, "upsert")
    upsert_table(spark, path, frame(spark, sf_dir, "gold_products"), retail.KEYS["products"])
    upsert_table(spark, path, frame(spark, sf_dir, "products"), retail.KEYS["products"])
    return read_table(spark, path).select(*PRODUCTS.names)


@query("""WITH old AS (SELECT o_orderkey, o_totalprice, year(o_orderdate) AS y FROM orders),
    new AS (SELECT o_orderkey * 2 AS o_orderkey, o_totalprice + 1 AS o_totalprice, 1999 AS y FROM orders
            WHERE year(o_orderdate) = 1999 AND o_orderkey * 2 NOT IN (SELECT o_orderkey FROM old WHERE y <> 1999))
    SELECT o_orderkey, o_totalprice, CAST(y AS INTEGER) AS y FROM new UNION ALL
    SELECT o_orderkey, o_totalprice, CAST(y AS INTEGER) AS y FROM old
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""")
def upsert_partitions(spark, sf_dir):
    """An upsert that touches one year rewrites only that year's partition."""
    path = scratch_folder(spark, "upsert-years")
    old = frame(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    upsert_table(spark, path, old, ["o_orderkey"], partition_by=["y"])
    shifted = old.filter("y = 1999").select(
        (F.col("o_orderkey") * 2).alias("o_orderkey"), (F.col("o_totalprice") + 1).alias("o_totalprice"), "y"
    )
    new = shifted.join(old.filter("y <> 1999").select("o_orderkey"), "o_orderkey", "left_anti")
    upsert_table(spark, path, new, ["o_orderkey"], partition_by=["y"])
    return read_table(spark, path, schema=old.schema)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem GROUP BY ALL""")
def csv_export(spark, sf_dir):
    """A small summary as one CSV file with a header."""
    path = scratch_folder(spark, "export")
    summary = frame(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines")
    )
    export_csv(summary, path, single_file=True)
    back = read_csv(spark, path, infer=False)
    return back.withColumn("lines", F.col("lines").cast("bigint"))


@query("""SELECT DATE '2024-01-15' AS day, count(*) AS rows_landed, count(*) > 0 AS has_landed
    FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def landing_check(spark, sf_dir):
    """How many rows of one day have landed in a table partitioned by day."""
    path = scratch_folder(spark, "landing")
    publish(frame(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), path, partition_by=["day"])
    return landed(read_table(spark, path), "2024-01-15", "day")


# Values that convert and values that do not, from real columns.
LOOSE = """SELECT p_partkey AS id,
    CASE p_partkey % 4 WHEN 0 THEN '2018-11-22' WHEN 1 THEN 'not a date' WHEN 2 THEN CAST(NULL AS STRING)
         ELSE '2019-02-30' END AS issued,
    CASE p_partkey % 3 WHEN 0 THEN '2018-11-22 10:11:12' WHEN 1 THEN 'later'
         ELSE '2018-12-01T00:00:01' END AS sold,
    CASE p_partkey % 3 WHEN 0 THEN '["' || p_brand || '","' || p_type || '"]' WHEN 1 THEN p_brand
         ELSE CAST(NULL AS STRING) END AS labels,
    p_size AS size, p_name AS name
    FROM {part}"""


_LOOSE_SCHEMA = (
    "id string, issued date, sold timestamp, labels array<string>, details string, sizes string, weight double"
)


@query(f"""WITH loose AS ({LOOSE.replace('{part}', 'part')})
    SELECT CAST(id AS VARCHAR) AS id, TRY_CAST(issued AS DATE) AS issued,
        TRY_CAST(sold AS TIMESTAMP) AS sold,
        CASE WHEN json_valid(labels) THEN array_to_string(CAST(labels AS VARCHAR[]), '|') ELSE labels END AS labels,
        '{{"size":' || size || ',"name":"' || name || '"}}' AS details,
        '[' || size || ',1]' AS sizes, CAST(NULL AS DOUBLE) AS weight
    FROM loose""")
def conform_schema(spark, sf_dir):
    """Loose columns to a target schema: dates, JSON text, arrays, an absent column."""
    loose = spark.sql(LOOSE, part=frame(spark, sf_dir, "part"))
    nested = loose.withColumn("details", F.struct("size", "name")).withColumn(
        "sizes", F.array(F.col("size"), F.lit(1))
    )
    typed = conform(nested, StructType.fromDDL(_LOOSE_SCHEMA))
    return typed.withColumn("labels", F.array_join("labels", "|"))


@query("""SELECT event_id, ts_day, kind FROM (
    SELECT event_id, CAST(ts AS DATE) AS ts_day, 'event' AS kind FROM events
    UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), CAST(NULL AS VARCHAR) FROM orders)""")
def union_platforms(spark, sf_dir):
    events = frame(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("ts_day"), F.lit("event").alias("kind")
    )
    orders = frame(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("ts_day"), F.col("o_orderkey").alias("event_id")
    )
    return align_union(events, orders)


CATEGORIES = """SELECT
    CASE WHEN p_partkey % 10 = 9 THEN 'v1|x|0'
         WHEN p_partkey % 2 = 0 THEN 'v1|' || CAST(100000000000 + p_partkey AS STRING) || '|0'
         ELSE 'v1|' || CAST(floor(p_partkey / 3) AS BIGINT) || '|9|0' END AS id,
    p_name AS product_name, p_retailprice AS price,
    CASE p_partkey % 5 WHEN 0 THEN 'junk' WHEN 1 THEN CAST(NULL AS STRING)
         WHEN 2 THEN '[{{"categoryId":"' || CAST(p_size AS STRING) || '","name":"a"}},{{"name":"b"}}]'
         WHEN 3 THEN '[]'
         ELSE '[{{"categoryId":"' || p_brand || '"}},{{"categoryId":"' || p_type || '"}}]' END AS categories
    FROM {part}"""
MARKET = CATEGORIES.format(part="part")
MARKET_ID = """TRY_CAST(string_split(substr(id, 4, length(id) - 5), '|')[1] AS BIGINT)"""


def _market(spark, sf_dir):
    return spark.sql(CATEGORIES, part=frame(spark, sf_dir, "part"))


@query(f"""WITH m AS ({MARKET}), t AS (SELECT {MARKET_ID} AS product_id, product_name, price FROM m)
    SELECT product_id, product_name, price, CAST(NULL AS VARCHAR) AS description,
        CAST(NULL AS VARCHAR) AS img_link, 'ebay' AS product_brand
    FROM ({duck.first_row('*', 't', 'product_id', 'product_name NULLS LAST, price NULLS LAST')})""")
def market_id(spark, sf_dir):
    """Numeric marketplace ids, one row per product."""
    return marketplace.shop_products(_market(spark, sf_dir))


EDGES = f"""WITH m AS ({MARKET}),
    e AS (SELECT {MARKET_ID} AS product_id,
        unnest(json_extract_string(categories, '$[*].categoryId')) AS category_id
        FROM m WHERE json_valid(categories))"""


@query(EDGES + " SELECT product_id, category_id FROM e WHERE category_id IS NOT NULL")
def category_edges(spark, sf_dir):
    return marketplace.category_edges(_market(spark, sf_dir))


@query(EDGES + " SELECT DISTINCT product_id, category_id FROM e WHERE category_id IS NOT NULL AND product_id IS NOT NULL")
def category_edges_twice(spark, sf_dir):
    """Stored edges after two feeds: other categories of all products, then the present ones."""
    folder = scratch_folder(spark, "market")
    items = _market(spark, sf_dir)
    before = items.withColumn("categories", F.lit('[{"categoryId":"old"},{"categoryId":"1"}]'))
    for feed in (before, items):
        marketplace.refresh(spark, feed, f"{folder}/shop", layout=["bucket_of_4"])
    return read_table(spark, f"{folder}/shop/category_edges")


@query(ctes("clients") + "SELECT count(*) AS files_rows, count(DISTINCT client_id) AS clients FROM clients")
def folder_sweep(spark, sf_dir):
    """All CSV files of a folder in one scan."""
    folder = scratch_folder(spark, "sweep")
    clients = frame(spark, sf_dir, "clients")
    clients.repartition(6, "client_id").write.option("header", True).csv(folder)
    return read_folder(spark, folder, "2024-01-01").agg(
        F.count(F.lit(1)).alias("files_rows"), F.count_distinct("client_id").alias("clients")
    )


@query(duck.first_row("event_type, user_id, event_id", "events", "event_type, user_id", "event_id"))
def dedup_subset(spark, sf_dir):
    """One row per key subset, the smallest event id."""
    events = frame(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    return dedup_on(events, ["event_type", "user_id"])
