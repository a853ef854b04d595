"""Retail and social tables derived from the given tables.

Each is one SELECT that Spark and DuckDB read alike, so that both sides of a check
start from the same rows.  Dirty values (NULLs, texts that do not parse, keys without
a match) are put in by rules on the keys, over the whole table.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

STANDINS: dict[str, str] = {}

STANDINS["purchases"] = """
SELECT CAST(l_partkey AS STRING) AS product_id,
       CAST(o_custkey AS STRING) AS client_id,
       CAST(l_orderkey AS STRING) AS transaction_id,
       CAST(o_orderdate AS TIMESTAMP) AS transaction_datetime,
       l_tax * 100 AS regular_points_received,
       l_extendedprice AS purchase_sum,
       CAST(l_suppkey AS STRING) AS store_id,
       CASE WHEN l_orderkey % 50 = 7 THEN CAST(0 AS DOUBLE)
            WHEN l_orderkey % 50 = 9 THEN CAST(NULL AS DOUBLE)
            ELSE l_quantity END AS product_quantity
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

STANDINS["bronze_purchases"] = """
SELECT CAST(l_partkey AS STRING) AS product_id,
       CAST(o_custkey AS STRING) AS client_id,
       CAST(l_orderkey AS STRING) AS transaction_id,
       CAST(o_orderdate AS TIMESTAMP) AS transaction_datetime,
       l_tax * 100 AS regular_points_received,
       l_extendedprice AS purchase_sum,
       CAST(l_suppkey AS STRING) AS store_id,
       CASE WHEN l_orderkey % 50 = 7 THEN CAST(0 AS DOUBLE)
            WHEN l_orderkey % 50 = 9 THEN CAST(NULL AS DOUBLE)
            ELSE l_quantity END AS product_quantity,
       CAST(l_shipdate AS TIMESTAMP) AS ingestion_time,
       'purchases-' || CAST(l_linenumber AS STRING) || '.csv' AS source_file
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# One row per (transaction, product): what a silver table already holds.
STANDINS["silver_purchases"] = """
SELECT product_id, min(client_id) AS client_id, transaction_id,
       min(transaction_datetime) AS transaction_datetime,
       min(regular_points_received) AS regular_points_received,
       min(purchase_sum) AS purchase_sum, min(store_id) AS store_id,
       min(product_quantity) AS product_quantity
FROM {purchases} GROUP BY transaction_id, product_id
"""

STANDINS["products"] = """
SELECT CASE WHEN p_partkey % 17 = 3 THEN 'old-' || CAST(p_partkey AS STRING)
            ELSE CAST(p_partkey AS STRING) END AS product_id,
       p_type AS level_1,
       'size ' || CAST(p_size AS STRING) AS level_2,
       CAST(NULL AS STRING) AS level_3,
       CAST(NULL AS STRING) AS level_4,
       p_brand AS brand_name,
       p_name AS product_name,
       CASE WHEN p_partkey % 19 = 5 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice END AS product_price,
       CAST(make_date(2018, CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))
            AS TIMESTAMP) AS first_issue_date
FROM {part}
"""

STANDINS["bronze_products"] = """
SELECT CAST(p_partkey AS STRING) AS product_id,
       p_type AS level_1,
       'size ' || CAST(p_size AS STRING) AS level_2,
       CASE WHEN l_linenumber = 1 THEN l_returnflag END AS level_3,
       CAST(NULL AS STRING) AS level_4,
       p_brand AS brand_name,
       p_name AS product_name,
       p_retailprice + l_linenumber AS product_price,
       CAST(l_shipdate AS TIMESTAMP) AS first_issue_date,
       CAST(l_shipdate AS TIMESTAMP) AS ingestion_time,
       'products-' || CAST(l_linenumber AS STRING) || '.csv' AS source_file
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

STANDINS["clients"] = """
SELECT CASE WHEN c_custkey % 101 = 0 THEN CAST(NULL AS STRING) ELSE CAST(c_custkey AS STRING) END
           AS client_id,
       '2018-01-' || CAST(10 + c_custkey % 18 AS STRING) AS first_issue_date,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING)
            ELSE '2018-02-' || CAST(10 + c_custkey % 18 AS STRING) END AS first_redeem_date,
       CAST(18 + c_custkey % 60 AS STRING) AS age,
       CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'U' END AS gender,
       c_name AS first_name,
       CAST(NULL AS STRING) AS middle_name,
       c_mktsegment AS last_name
FROM {customer}
"""

STANDINS["bronze_clients"] = """
SELECT CAST(c_custkey AS STRING) AS client_id,
       '2018-01-' || CAST(10 + c_custkey % 18 AS STRING) AS first_issue_date,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS first_redeem_date,
       CAST(18 + o_orderkey % 60 AS STRING) AS age,
       CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'U' END AS gender,
       c_name AS first_name,
       o_orderpriority AS middle_name,
       c_mktsegment AS last_name,
       CAST(o_orderdate AS TIMESTAMP) AS ingestion_time,
       'clients-' || o_orderstatus || '.csv' AS source_file
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Half of these keys are among the clients, half are not.
STANDINS["gold_clients"] = """
SELECT CAST(c_custkey * 2 AS STRING) AS client_id,
       '2017-06-01' AS first_issue_date,
       CAST(NULL AS STRING) AS first_redeem_date,
       CAST(20 + c_custkey % 50 AS STRING) AS age,
       'U' AS gender
FROM {customer}
"""

# Text after the comma: provinces with accents, aliases, odd case, none, and no match.
STANDINS["stores"] = """
SELECT CAST(s_suppkey AS STRING) AS store_id,
       s_name AS store_name,
       CASE s_suppkey % 9
            WHEN 0 THEN n_name || ', Hà Nội'
            WHEN 1 THEN n_name || ',  đà   nẵng '
            WHEN 2 THEN n_name || ', TP Hồ Chí Minh'
            WHEN 3 THEN n_name || ', CẦN THƠ'
            WHEN 4 THEN 'Thừa Thiên Huế'
            WHEN 5 THEN n_name || ', Đắk Lắk'
            WHEN 6 THEN n_name || ', Hanoi'
            WHEN 7 THEN CAST(NULL AS STRING)
            ELSE n_name || ', ' || r_name END AS store_location,
       r_name AS region,
       CASE WHEN s_acctbal < 3000 THEN 'Supermarket' ELSE 'Flagship store' END AS store_format,
       CAST(make_date(2018, CAST(1 + s_suppkey % 12 AS INT), CAST(1 + s_suppkey % 28 AS INT))
            AS TIMESTAMP) AS first_issue_date
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

STANDINS["bronze_stores"] = """
SELECT store_id,
       store_name || ' v' || CAST(l_linenumber AS STRING) AS store_name,
       store_location, region, store_format, first_issue_date,
       CAST(l_shipdate AS TIMESTAMP) AS ingestion_time,
       'stores-' || l_returnflag || '.csv' AS source_file
FROM {lineitem} JOIN {stores} ON CAST(l_suppkey AS STRING) = store_id
"""

# Half of these keys are among the stores, half are not.
STANDINS["gold_stores"] = """
SELECT CAST(s_suppkey * 2 AS STRING) AS store_id,
       'Old ' || s_name AS store_name,
       CAST(NULL AS STRING) AS store_location,
       'unknown' AS region,
       'Supermarket' AS store_format,
       CAST(make_date(2017, 1, 1) AS TIMESTAMP) AS first_issue_date
FROM {supplier}
"""

# Products known before a batch: every second key, old prices.
STANDINS["gold_products"] = """
SELECT CAST(p_partkey * 2 AS STRING) AS product_id,
       'OLD' AS level_1,
       CAST(NULL AS STRING) AS level_2, CAST(NULL AS STRING) AS level_3, CAST(NULL AS STRING) AS level_4,
       p_brand AS brand_name,
       'old ' || p_name AS product_name,
       p_retailprice * 2 AS product_price,
       CAST(make_date(2017, 1, 1) AS TIMESTAMP) AS first_issue_date
FROM {part}
"""

STANDINS["silver_posts"] = """
SELECT CAST(event_id AS STRING) AS post_id,
       'u' || CAST(user_id AS STRING) AS user_id,
       props AS post_content,
       CASE WHEN event_id % 97 = 5 THEN CAST(NULL AS TIMESTAMP) ELSE CAST(ts AS TIMESTAMP) END AS post_date,
       'https://social.example/p/' || CAST(event_id AS STRING) AS post_url,
       event_type AS post_type
FROM {events}
"""

STANDINS["silver_users"] = """
SELECT 'u' || CAST(user_id AS STRING) AS user_id,
       'User ' || CAST(user_id AS STRING) AS display_name,
       'https://social.example/u/' || CAST(user_id AS STRING) AS biography,
       true AS is_verified,
       CAST(count(*) AS INT) AS following,
       CAST(count(DISTINCT event_type) AS INT) AS followed,
       CAST(count(*) * 2 AS INT) AS post,
       CASE user_id % 3 WHEN 0 THEN 'product' WHEN 1 THEN 'Instagram' END AS user_type
FROM {events} GROUP BY user_id
"""

# Links of posts: some of a second platform under the same id, some of no post, some mentions of nobody.
STANDINS["post_links"] = """
SELECT CASE WHEN event_id % 5 = 0 THEN 'mirror' ELSE event_type END AS post_type,
       CASE WHEN event_id % 31 = 4 THEN 'gone-' || CAST(event_id AS STRING)
            ELSE CAST(event_id AS STRING) END AS post_id,
       user_id % 40 AS hashtag_id,
       CASE WHEN event_id % 23 = 9 THEN CAST(NULL AS STRING)
            ELSE 'user ' || CAST((user_id * 7) % 1000 AS STRING) END AS mentioned_name,
       CASE WHEN event_id % 23 = 9 OR event_id % 19 = 2 THEN CAST(NULL AS STRING)
            ELSE 'u' || CAST((user_id * 7) % 1000 AS STRING) END AS mentioned_user_id
FROM {events}
"""

# Some posts once more with other dates, on their own platform and on another one, so that neither
# the id alone nor the platform and the id are unique.
STANDINS["repeated_posts"] = """
SELECT post_type, post_id, post_date FROM {silver_posts}
UNION ALL
SELECT CASE WHEN o_orderstatus = 'F' THEN post_type ELSE 'mirror' END AS post_type, post_id,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS TIMESTAMP) ELSE post_date END AS post_date
FROM {silver_posts} JOIN {orders} ON post_id = CAST(o_orderkey AS STRING)
"""

_TAG_LIST = """CASE event_id % 9
            WHEN 0 THEN CAST(NULL AS STRING)
            WHEN 1 THEN 'NULL'
            WHEN 2 THEN 'unknown'
            WHEN 3 THEN '["' || event_type || '","K' || CAST(user_id % 9 AS STRING) || '","' || event_type || '"]'
            WHEN 4 THEN '[ "Sale" , "null", "", "' || CAST(user_id AS STRING) || '" ]'
            WHEN 5 THEN '["null_hehe"_hehe","k' || CAST(user_id % 9 AS STRING) || '"]'
            WHEN 6 THEN '  '
            WHEN 7 THEN '["Sale","sale"]'
            ELSE '["' || event_type || ':' || CAST(user_id AS STRING) || '"; "x:null"; "none"]' END"""


def _instagram(where: str, mention: str) -> str:
    return f"""
SELECT CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING)
            ELSE 'https://www.instagram.com/p/' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING) || '/'
            END AS url,
       'user' || CAST(user_id AS STRING) AS comment_user,
       CASE event_id % 13 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'user' || CAST(user_id AS STRING)
            WHEN 2 THEN '' ELSE 'https://www.instagram.com/user' || CAST(user_id AS STRING) || '/'
            END AS comment_user_url,
       CASE WHEN event_id % 10 = 3 THEN 'soon' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS comment_date,
       CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS STRING) ELSE props END AS comment,
       CASE WHEN event_id % 6 = 0 THEN CAST(NULL AS INT) ELSE CAST(event_id % 900 AS INT) END AS likes_number,
       CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS INT) ELSE CAST(event_id % 30 AS INT) END AS replies_number,
       CAST(NULL AS STRING) AS replies,
       {_TAG_LIST} AS hashtag_comment,
       CASE event_id % 5 WHEN 0 THEN CAST(NULL AS STRING)
            WHEN 1 THEN 'https://www.instagram.com/user' || CAST((user_id * 7) % 1200 AS STRING)
            WHEN 2 THEN 'unknown'
            ELSE ' user' || CAST((user_id * 3) % 1200 AS STRING) END AS {mention},
       CASE WHEN event_id % 12 = 0 THEN CAST(NULL AS STRING)
            ELSE 'https://www.instagram.com/p/' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING) || '/'
            END AS post_url,
       'https://www.instagram.com/user' || CAST(user_id AS STRING) || '/' AS post_user,
       CASE event_id % 5 WHEN 0 THEN CAST(100000000000 + event_id AS STRING) WHEN 1 THEN 'abc'
            WHEN 2 THEN CAST(NULL AS STRING) WHEN 3 THEN '12345'
            ELSE CAST(900000000000 - event_id AS STRING) END AS comment_id,
       CASE event_id % 4 WHEN 0 THEN CAST(200000000000 + user_id AS STRING) WHEN 1 THEN ''
            WHEN 2 THEN CAST(NULL AS STRING) ELSE 'p' || CAST(user_id AS STRING) END AS post_id
FROM {{events}} {where}
"""


def _tiktok(where: str) -> str:
    return f"""
SELECT CASE WHEN event_id % 9 = 0 THEN CAST(NULL AS STRING)
            ELSE 'https://www.tiktok.com/v/' || CAST(event_id AS STRING) END AS url,
       CASE WHEN event_id % 8 = 0 THEN CAST(NULL AS STRING)
            ELSE 'https://www.tiktok.com/@shop/video/' || CAST(CAST(floor(event_id / 4) AS BIGINT) AS STRING)
            END AS post_url,
       CASE WHEN event_id % 72 = 0 THEN CAST(NULL AS STRING)
            WHEN event_id % 3 = 0 THEN CAST(7200000000000000000 + event_id AS STRING) WHEN event_id % 3 = 1 THEN '7123456789012345678'
            ELSE CAST(NULL AS STRING) END AS post_id,
       CASE WHEN event_id % 6 = 1 THEN 'yesterday' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS post_date_created,
       CASE WHEN event_id % 6 = 2 THEN CAST(NULL AS STRING)
            ELSE CAST(CAST(ts AS DATE) AS STRING) || ' 10:20:30' END AS date_created,
       CASE WHEN event_id % 4 = 1 THEN CAST(NULL AS STRING) ELSE props END AS comment_text,
       CASE event_id % 8 WHEN 0 THEN 'abc' WHEN 1 THEN '1.5' WHEN 2 THEN '1e3' WHEN 3 THEN '99999999999'
            WHEN 4 THEN '' WHEN 5 THEN ' 12 ' WHEN 6 THEN CAST(NULL AS STRING)
            ELSE CAST(user_id AS STRING) END AS num_likes,
       CASE WHEN event_id % 2 = 0 THEN '3' ELSE 'few' END AS num_replies,
       CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS STRING) ELSE 'user' || CAST(user_id AS STRING) END
           AS commenter_user_name,
       CASE WHEN event_id % 5 = 1 THEN CAST(NULL AS STRING) ELSE CAST(user_id AS STRING) END AS commenter_id,
       CASE event_id % 6 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN ''
            WHEN 2 THEN 'https://example.com/user' || CAST(user_id AS STRING)
            WHEN 3 THEN 'https://www.tiktok.com/@user' || CAST(user_id AS STRING) || '?x=1'
            ELSE 'https://www.tiktok.com/@user' || CAST(user_id AS STRING) END AS commenter_url,
       CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS STRING) ELSE 'c' || CAST(event_id AS STRING) END
           AS comment_id,
       CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS STRING)
            ELSE 'https://www.tiktok.com/c/' || CAST(event_id AS STRING) END AS comment_url
FROM {{events}} {where}
"""


def _twitter(where: str) -> str:
    return f"""
SELECT CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 25 = 3 THEN '7123456789012345678'
            WHEN event_id % 25 = 4 THEN 'n/a' WHEN event_id % 25 = 6 THEN '99999999999999999999'
            ELSE CAST(1790000000000000000 + event_id AS STRING) END AS id,
       CASE event_id % 9 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'unknown'
            WHEN 3 THEN '"quoted' ELSE 'User ' || CAST(user_id AS STRING) END AS user_posted,
       CASE event_id % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN 'https://x.com/a' WHEN 2 THEN '"q'
            WHEN 3 THEN 'mary' WHEN 4 THEN CAST(NULL AS STRING)
            ELSE 'Name ' || CAST(user_id AS STRING) END AS name,
       props AS description,
       CASE event_id % 4 WHEN 0 THEN 'no date' WHEN 1 THEN CAST(NULL AS STRING)
            ELSE CAST(CAST(ts AS DATE) AS STRING) || ' 01:02:03' END AS date_posted,
       CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS INT) ELSE CAST(event_id % 4 AS INT) END AS photos,
       CASE WHEN event_id % 4 = 3 THEN CAST(NULL AS STRING)
            ELSE 'https://x.com/u/status/' || CAST(event_id AS STRING) END AS url,
       CASE event_id % 4 WHEN 0 THEN CAST(NULL AS STRING)
            WHEN 1 THEN 'https://x.com/User ' || CAST((user_id * 7) % 1200 AS STRING)
            ELSE 'User ' || CAST((user_id * 3) % 1200 AS STRING) END AS tagged_users,
       CASE WHEN event_id % 2 = 0 THEN 'n/a' ELSE CAST(event_id % 50 AS STRING) END AS replies,
       CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS STRING) ELSE CAST(event_id % 60 AS STRING) END AS reposts,
       CASE WHEN event_id % 4 = 0 THEN '1.5' ELSE CAST(event_id % 70 AS STRING) END AS likes,
       CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(event_id % 80 AS STRING) END AS views,
       CAST(NULL AS STRING) AS external_url,
       CASE event_id % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'null'
            WHEN 2 THEN event_type || ', "K' || CAST(user_id % 9 AS STRING) || '",' || event_type
            ELSE '"Sale"' END AS hashtags,
       CASE WHEN event_id % 6 = 0 THEN CAST(NULL AS INT) ELSE CAST(user_id AS INT) END AS followers,
       CAST(NULL AS STRING) AS biography,
       CASE WHEN event_id % 6 = 1 THEN CAST(NULL AS INT) ELSE CAST(user_id AS INT) END AS posts_count,
       CAST(NULL AS STRING) AS profile_image_link,
       CASE WHEN event_id % 6 = 2 THEN CAST(NULL AS INT) ELSE CAST(user_id AS INT) END AS following,
       'true' AS is_verified,
       CAST(NULL AS STRING) AS quotes, CAST(NULL AS STRING) AS bookmarks,
       CAST(NULL AS STRING) AS parent_post_details, CAST(NULL AS STRING) AS external_image_urls,
       CASE WHEN event_id % 6 = 3 THEN CAST(NULL AS INT) ELSE 1 END AS videos,
       CAST(NULL AS STRING) AS quoted_post
FROM {{events}} {where}
"""


def _facebook(where: str) -> str:
    return f"""
SELECT 'fb' || CAST(user_id AS STRING) AS user_id,
       'User ' || CAST(user_id AS STRING) AS user_name,
       'https://facebook.com/user' || CAST(user_id AS STRING) || CASE WHEN event_id % 5 = 0 THEN '/' ELSE '' END
           AS user_url,
       CASE event_id % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN ''
            ELSE 'fb' || CAST(CAST(floor(event_id / 6) AS BIGINT) AS STRING) END AS post_id,
       CASE WHEN event_id % 16 = 0 THEN CAST(NULL AS STRING)
            ELSE 'https://facebook.com/posts/' || CAST(CAST(floor(event_id / 6) AS BIGINT) AS STRING) END
           AS post_url,
       CAST(CAST(ts AS DATE) AS STRING) AS date_created,
       'https://facebook.com/c/' || CAST(event_id AS STRING) AS url
FROM {{events}} {where}
"""


# Every event as a row of one platform.
STANDINS["instagram"] = _instagram("", "tagged_users_in_comment")
STANDINS["tiktok"] = _tiktok("")
STANDINS["twitter"] = _twitter("")
STANDINS["facebook"] = _facebook("")

# The events shared out over the platforms, for queries that read all four.
STANDINS["facebook_csv"] = _facebook("WHERE event_type IN ('signup', 'error')")
STANDINS["instagram_csv"] = _instagram("WHERE event_type = 'click'", "tagged_user_in")
STANDINS["tiktok_csv"] = _tiktok("WHERE event_type = 'view'")
STANDINS["twitter_csv"] = _twitter("WHERE event_type = 'purchase'")


def _references(name: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(STANDINS[name]) if field})


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in or a given table as a DataFrame."""
    if name not in STANDINS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {ref: frame(spark, sf_dir, ref) for ref in _references(name)}
    return spark.sql(STANDINS[name], **inputs)


def ctes(*names: str, **extra: str) -> str:
    """A WITH clause that defines the stand-ins, those they use, and ``extra`` ones."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in STANDINS and name not in ordered:
            for ref in _references(name):
                add(ref)
            ordered.append(name)

    for name in names:
        add(name)
    parts = []
    for name in ordered:
        refs = {ref: ref for ref in _references(name)}
        parts.append(f"{name} AS ({STANDINS[name].format(**refs)})")
    parts += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"
