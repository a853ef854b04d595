"""Column work: repair of dirty values, text and URL functions, picks and lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwater.functions.dates import date_key
from tillwater.functions.hashing import digits_id, hash_id, pick, pick_int
from tillwater.functions.regions import provinces_by_region
from tillwater.functions.repair import (
    parsed_int, repair_id, repair_int, repair_name, repair_text, repair_ts, repair_url,
)
from tillwater.functions.sql import register_functions
from tillwater.functions.text import (
    FALLBACK_NAMES, first_post_id, instagram_handle, last_segment, level, tag_pairs, tags,
    tiktok_handle, twitter_name, twitter_profile,
)
from tillwater.operators.aggregates import first_date, id_lists, last_writer, preview, sample_rows
from tillwater.operators.keys import resolve, surrogate
from tillwater.operators.shape import harmonize
from tillwater.plans import social_repair
from tillwater.plans.retail import described_stores
from tillwater.plans.social_entities import RENAMES, clean_posts, refresh_silver
from tillwater.sources.files import scratch_folder
from tillwater.sources.schemas import layout
from tillwater.sources.tables import read_table, replace_partitions
from tillwater.streaming.products import parse_json
from workload import duck
from workload.registry import SQL, query
from workload.standins import ctes, frame

AS_OF = "2024-02-01 00:00:00"
AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


# --- repair -------------------------------------------------------------------------

@query(ctes("tiktok") + f"""SELECT comment_url, comment_id, post_url, url,
    CAST(coalesce({duck.parsed_int('num_likes')}, {duck.pick_int(1, 20, 'url', 'comment_id')}) AS INTEGER)
        AS num_likes, CASE WHEN {duck.parsed_int('num_likes')} IS NULL THEN 'made' ELSE 'kept' END AS origin
    FROM tiktok""")
def repair_numeric(spark, sf_dir):
    rows = frame(spark, sf_dir, "tiktok")
    return rows.select(
        "comment_url", "comment_id", "post_url", "url",
        repair_int("num_likes", pick_int(1, 20, "url", "comment_id")).alias("num_likes"),
        F.when(parsed_int("num_likes").isNull(), "made").otherwise("kept").alias("origin"),
    )


@query(ctes("twitter") + f"""SELECT id, description, url,
    coalesce(TRY_CAST(date_posted AS TIMESTAMP), {AS_OF_SQL} - INTERVAL 10 DAY) AS date_posted FROM twitter""")
def repair_timestamp(spark, sf_dir):
    rows = frame(spark, sf_dir, "twitter")
    return rows.select("id", "description", "url", repair_ts("date_posted", AS_OF, 10).alias("date_posted"))


@query(ctes("instagram") + f"""SELECT comment_user, comment_id AS raw_id, comment_date, post_url,
    CASE WHEN regexp_full_match(comment_id, '[0-9]{{12}}') THEN CAST(comment_id AS BIGINT)
         ELSE {duck.digits_id(12, 'comment_user', 'post_url')} END AS comment_id FROM instagram""", name="repair_id")
def repair_id_column(spark, sf_dir):
    rows = frame(spark, sf_dir, "instagram")
    return rows.select(
        "comment_user", F.col("comment_id").alias("raw_id"), "comment_date", "post_url",
        repair_id("comment_id", digits_id(12, "comment_user", "post_url")).alias("comment_id"),
    )


@query(ctes("twitter") + f"""SELECT id, url, description,
    CASE WHEN name = 'unknown' OR name LIKE 'https%' OR name LIKE '"%' OR name LIKE 'm%'
         THEN {duck.fallback_name('id', 'url')} ELSE name END AS name FROM twitter""", name="repair_name")
def repair_name_column(spark, sf_dir):
    rows = frame(spark, sf_dir, "twitter")
    chosen = pick(FALLBACK_NAMES, "id", "url")
    return rows.select(
        "id", "url", "description",
        repair_name("name", chosen, ["unknown"], social_repair.NAME_PREFIXES).alias("name"),
    )


@query(ctes("twitter") + """SELECT id, description, coalesce(url, 'https://x.com/starwars/' || id) AS url
    FROM twitter""", name="repair_url")
def repair_url_column(spark, sf_dir):
    rows = frame(spark, sf_dir, "twitter")
    return rows.select("id", "description", repair_url("url", social_repair.TWITTER_URL, "id").alias("url"))


@query(ctes("instagram") + """SELECT coalesce(url, 'unknown') AS url, coalesce(comment, 'unknown') AS comment,
    likes_number, coalesce(hashtag_comment, 'unknown') AS hashtag_comment,
    coalesce(post_url, 'none') AS post_url FROM instagram""")
def fill_unknown(spark, sf_dir):
    rows = frame(spark, sf_dir, "instagram")
    return (
        rows.select("url", "comment", "likes_number", "hashtag_comment", repair_text("post_url", "none").alias("post_url"))
        .fillna("unknown")
    )


def _numbered(name: str, columns: list[str]) -> str:
    """The rows with two numbers from the md5 of all columns."""
    listed = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    digest = f"md5(concat_ws('|', {listed}))"
    return f"""(SELECT *, CAST('0x' || substr({digest}, 1, 15) AS BIGINT) AS h1,
        CAST('0x' || substr({digest}, 16, 15) AS BIGINT) AS h2 FROM {name})"""


def _draw(number: str, weight: int, low: int, high: int) -> str:
    return f"(({number} // {weight}) % {high - low + 1} + {low})"


def _int(column: str, draw: str) -> str:
    return f"CAST(coalesce({duck.parsed_int(column)}, {draw}) AS INTEGER) AS {column}"


def _twelve(column: str, draw: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '[0-9]{{12}}') THEN CAST({column} AS BIGINT) "
        f"ELSE {draw} END AS {column}"
    )


INSTAGRAM_COLUMNS = [
    "url", "comment_user", "comment_user_url", "comment_date", "comment", "likes_number",
    "replies_number", "replies", "hashtag_comment", "tagged_users_in_comment", "post_url",
    "post_user", "comment_id", "post_id",
]
INSTAGRAM_TEXTS = [
    c for c in INSTAGRAM_COLUMNS if c not in ("likes_number", "replies_number", "comment_id", "post_id")
]


@query(ctes("instagram") + "SELECT " + ", ".join([
    *[f"coalesce({c}, 'unknown') AS {c}" for c in INSTAGRAM_TEXTS],
    _int("likes_number", _draw("h1", 1, 0, 100)),
    _int("replies_number", _draw("h1", 101, 0, 100)),
    _twelve("comment_id", _draw("h1", 101 * 101, 10**11, 10**12 - 1)),
    _twelve("post_id", _draw("h2", 1, 10**11, 10**12 - 1)),
]) + f" FROM {_numbered('instagram', INSTAGRAM_COLUMNS)}")
def repair_instagram(spark, sf_dir):
    return social_repair.repair_instagram(frame(spark, sf_dir, "instagram"))


TIKTOK_COLUMNS = [
    "url", "post_url", "post_id", "post_date_created", "date_created", "comment_text", "num_likes",
    "num_replies", "commenter_user_name", "commenter_id", "commenter_url", "comment_id", "comment_url",
]


@query(ctes("tiktok", fixed="SELECT " + ", ".join([
    *[_int(c, _draw("h1", 20**place, 1, 20)) for place, c in enumerate(("num_likes", "num_replies"))],
    *[f"CASE WHEN trim({c}_id) <> '' THEN {c}_id ELSE {duck.row_id(c, *TIKTOK_COLUMNS)} END AS {c}_id"
      for c in ("comment", "post")],
    *[f"coalesce(TRY_CAST({c} AS TIMESTAMP), {AS_OF_SQL} - INTERVAL 1 DAY) AS {c}"
      for c in ("post_date_created", "date_created")],
    *[f"coalesce({c}, 'unknown') AS {c}" for c in ("comment_text", "commenter_user_name", "commenter_id")],
    "coalesce(commenter_url, 'https://tiktok.com/@username') AS commenter_url",
    "url", "post_url", "comment_url",
]) + f" FROM {_numbered('tiktok', TIKTOK_COLUMNS)}") + "SELECT * REPLACE (" + ", ".join(
    f"coalesce({c}, 'https://tiktok.com/@username/video/' || comment_id) AS {c}"
    for c in ("url", "post_url", "comment_url")
) + ") FROM fixed")
def repair_tiktok(spark, sf_dir):
    return social_repair.repair_tiktok(frame(spark, sf_dir, "tiktok"), AS_OF)


TWITTER_COLUMNS = [
    "id", "user_posted", "name", "description", "date_posted", "photos", "url", "tagged_users",
    "replies", "reposts", "likes", "views", "external_url", "hashtags", "followers", "biography",
    "posts_count", "profile_image_link", "following", "is_verified", "quotes", "bookmarks",
    "parent_post_details", "external_image_urls", "videos", "quoted_post",
]
TWITTER_KEPT = [
    "description", "external_url", "hashtags", "biography", "profile_image_link", "is_verified",
    "quotes", "bookmarks", "parent_post_details", "external_image_urls", "quoted_post", "url",
]
NAMES = len(FALLBACK_NAMES)
NAME_LIST = "[" + ", ".join(duck.text(n) for n in FALLBACK_NAMES) + "]"


@query(ctes("twitter", fixed="SELECT " + ", ".join([
    *TWITTER_KEPT,
    f"coalesce({duck.parsed_long('id')}, {duck.row_id('post', *TWITTER_COLUMNS)}) AS id",
    f"""CASE WHEN user_posted IN ('unknown', '') OR user_posted LIKE '"%'
        THEN {NAME_LIST}[1 + {_draw('h1', 1, 0, NAMES - 1)}] ELSE user_posted END AS user_posted""",
    f"""CASE WHEN name = 'unknown' OR name LIKE 'https%' OR name LIKE '"%' OR name LIKE 'm%'
        THEN {NAME_LIST}[1 + {_draw('h1', NAMES, 0, NAMES - 1)}] ELSE name END AS name""",
    f"coalesce(TRY_CAST(date_posted AS TIMESTAMP), {AS_OF_SQL} - INTERVAL 10 DAY) AS date_posted",
    "coalesce(tagged_users, 'unknown') AS tagged_users",
    *[_int(c, _draw("h1", NAMES**2 * 20**place, 1, 20))
      for place, c in enumerate(social_repair.TWITTER_COUNTERS)],
]) + f" FROM {_numbered('twitter', TWITTER_COLUMNS)}") + """
    SELECT * REPLACE (coalesce(url, 'https://x.com/starwars/' || id) AS url) FROM fixed""")
def repair_twitter(spark, sf_dir):
    return social_repair.repair_twitter(frame(spark, sf_dir, "twitter"), AS_OF)


# --- text, URLs, tags ---------------------------------------------------------------

URLS = """SELECT page_id, CASE page_id % 6 WHEN 0 THEN url || '/' WHEN 1 THEN url WHEN 2 THEN ''
    WHEN 3 THEN replace(url, '/', '') WHEN 4 THEN CAST(NULL AS STRING) ELSE url || '//' END AS url
    FROM {pages}"""


@query(f"""SELECT page_id, {duck.last_segment('url')} AS segment FROM ({URLS.format(pages='pages')})""")
def url_segment(spark, sf_dir):
    urls = spark.sql(URLS, pages=frame(spark, sf_dir, "pages"))
    return urls.select("page_id", last_segment("url").alias("segment"))


@query(ctes("facebook") + f"""SELECT url AS comment_url, coalesce(nullif(post_id, ''),
    {duck.last_segment('CAST(NULL AS VARCHAR)')}, {duck.last_segment('post_url')}) AS post_id FROM facebook""")
def post_id_extract(spark, sf_dir):
    rows = frame(spark, sf_dir, "facebook").withColumn("other", F.lit(None).cast("string"))
    return rows.select(
        F.col("url").alias("comment_url"), first_post_id("post_id", "other", "post_url").alias("post_id")
    )


INSTAGRAM_HANDLE = f"""CASE WHEN len(string_split(trim(comment_user_url), '/')) >= 2
    THEN string_split(trim(comment_user_url), '/')[-2] ELSE {duck.fallback_name('comment_user')} END"""


@query(ctes("instagram") + f"""SELECT comment_user, comment_user_url, {INSTAGRAM_HANDLE} AS display_name,
    coalesce(comment_user_url, '') AS biography, post_url, comment_id FROM instagram""")
def insta_handle(spark, sf_dir):
    return frame(spark, sf_dir, "instagram").select(
        "comment_user", "comment_user_url",
        instagram_handle("comment_user_url", "comment_user").alias("display_name"),
        F.coalesce("comment_user_url", F.lit("")).alias("biography"), "post_url", "comment_id",
    )


TIKTOK_HANDLE = r"""CASE WHEN commenter_url <> '' THEN coalesce(
    nullif(regexp_extract(commenter_url, 'tiktok\.com/@([^/?]+)', 1), ''), {}) END"""


@query(ctes("tiktok") + f"""SELECT comment_id, commenter_url,
    {TIKTOK_HANDLE.format(duck.fallback_name('comment_id'))} AS display_name FROM tiktok""", name="tiktok_handle")
def tiktok_handle_column(spark, sf_dir):
    return frame(spark, sf_dir, "tiktok").select(
        "comment_id", "commenter_url", tiktok_handle("commenter_url", "comment_id").alias("display_name")
    )


TWITTER_NAME = """CASE WHEN trim(coalesce(user_posted, '')) = '' THEN {} ELSE user_posted END"""


@query(ctes("twitter") + f"""SELECT description, url, display_name,
    'http://x.com/' || lower(replace(display_name, ' ', '')) AS biography
    FROM (SELECT *, {TWITTER_NAME.format(duck.fallback_name('id', 'url'))} AS display_name FROM twitter)""", name="twitter_profile")
def twitter_profile_url(spark, sf_dir):
    rows = frame(spark, sf_dir, "twitter").withColumn("display_name", twitter_name("user_posted", "id", "url"))
    return rows.select("description", "url", "display_name", twitter_profile("display_name").alias("biography"))


@query(ctes("instagram") + f"""SELECT comment_user, comment_id, post_url,
    unnest({duck.tags('hashtag_comment', True)}) AS tag FROM instagram""")
def hashtag_list(spark, sf_dir):
    return frame(spark, sf_dir, "instagram").select(
        "comment_user", "comment_id", "post_url", F.explode(tags("hashtag_comment")).alias("tag")
    )


PAIRS = """SELECT event_id, CASE event_id % 4
        WHEN 0 THEN '[' || replace(replace(props, '{{', ''), '}}', '') || ']'
        WHEN 1 THEN '["' || event_type || ':' || CAST(user_id AS STRING) || '"; "x:null"; plain; ":v"]'
        WHEN 2 THEN 'a:1,b:2:3, c : ' || event_type
        ELSE CAST(NULL AS STRING) END AS pairs FROM {events}"""
PAIR_TEXT = "trim(trim(pairs), '[]')"


@query(f"""WITH p AS (SELECT event_id, {duck.unquoted("unnest(string_split(" + PAIR_TEXT + ", CASE WHEN contains("
       + PAIR_TEXT + ", ';') THEN ';' ELSE ',' END))")} AS part FROM ({PAIRS.format(events='events')})),
    kv AS (SELECT event_id, trim(split_part(part, ':', 1)) AS key,
        trim(substr(part, instr(part, ':') + 1)) AS value FROM p WHERE contains(part, ':'))
    SELECT * FROM kv WHERE key <> '' AND value NOT IN ('', 'null_hehe"_hehe') AND lower(value) <> 'null'""")
def hashtag_pairs(spark, sf_dir):
    rows = spark.sql(PAIRS, events=frame(spark, sf_dir, "events"))
    pairs = rows.select("event_id", F.explode(tag_pairs("pairs")).alias("pair"))
    return pairs.select("event_id", "pair.key", "pair.value")


@query(SQL["hashtag_pairs"])
def parse_hashtags(spark, sf_dir):
    """The same pairs through the function registered for SQL."""
    register_functions(spark)
    rows = spark.sql(PAIRS, events=frame(spark, sf_dir, "events"))
    return spark.sql(
        "SELECT event_id, pair.key, pair.value FROM "
        "(SELECT event_id, parse_hashtags(pairs) AS found FROM {rows}) LATERAL VIEW explode(found) p AS pair",
        rows=rows,
    )


@query("""SELECT * FROM (SELECT event_id, unnest([nullif('u' || user_id % 7, 'u0'),
        CASE WHEN event_id % 3 = 0 THEN event_type END]) AS mention FROM events) WHERE mention IS NOT NULL""")
def mention_explode(spark, sf_dir):
    """Two mention columns packed, exploded, NULLs dropped."""
    events = frame(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.concat(F.lit("u"), (F.col("user_id") % 7).cast("string")), F.lit("u0")).alias("tagged_user_in"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("tagged_users"),
    )
    exploded = events.select("event_id", F.explode(F.array("tagged_user_in", "tagged_users")).alias("mention"))
    return exploded.filter(F.col("mention").isNotNull())


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN [p_size, 8, 9, 10, 11]
        WHEN 1 THEN [p_size, 8] WHEN 2 THEN [] ELSE NULL END AS ids FROM part)
    SELECT p_partkey, CAST(ids[1] AS VARCHAR) AS level_1, CAST(ids[2] AS VARCHAR) AS level_2,
        CAST(ids[3] AS VARCHAR) AS level_3, CAST(ids[4] AS VARCHAR) AS level_4 FROM p""")
def category_levels(spark, sf_dir):
    parts = frame(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 4 == 0, F.array("p_size", F.lit(8), F.lit(9), F.lit(10), F.lit(11)))
        .when(F.col("p_partkey") % 4 == 1, F.array("p_size", F.lit(8)))
        .when(F.col("p_partkey") % 4 == 2, F.array().cast("array<int>"))
        .alias("ids"),
    )
    return parts.select("p_partkey", *[level("ids", n).alias(f"level_{n}") for n in (1, 2, 3, 4)])


REGION_CASE = "CASE WHEN store_location IS NULL THEN NULL " + " ".join(
    f"WHEN province IN ({', '.join(duck.text(p) for p in provinces)}) THEN '{region}'"
    for region, provinces in provinces_by_region().items()
) + " ELSE 'unknown' END"


@query(ctes("stores", folded="""SELECT store_id, store_location, store_format,
        trim(regexp_replace(translate(strip_accents(string_split(store_location, ',')[-1]), 'đĐ', 'dD'), '\\s+', ' ', 'g'))
            AS folded FROM stores""",
       named="""SELECT *, array_to_string(list_transform(string_split(folded, ' '),
            lambda w: upper(w[1]) || lower(w[2:])), ' ') AS province FROM folded""")
       + f"""SELECT store_id, store_location, {REGION_CASE} AS region,
           store_format FROM named""")
def region_lookup(spark, sf_dir):
    """The region a store's location lies in."""
    stores = described_stores(frame(spark, sf_dir, "stores"))
    return stores.select("store_id", "store_location", "region", "store_format")


@query("""SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_parse(spark, sf_dir):
    """JSON text to a struct by schema."""
    schema = layout("k int")
    events = frame(spark, sf_dir, "events").withColumn("p", parse_json(F.col("props"), schema))
    return events.select("event_id", "event_type", "p.k")


# --- ids, lookups, lists ------------------------------------------------------------

@query(f"""SELECT DISTINCT event_type, user_id, {duck.hash_id('event_type', 'user_id')} AS surrogate_id
    FROM events""")
def surrogate_id(spark, sf_dir):
    """A stable id per (platform, key)."""
    keys = frame(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    return surrogate(keys, "surrogate_id", "event_type", "user_id")


@query("""WITH dim AS (SELECT 'user' || user_id AS name, min(event_id) AS known_id FROM events
        WHERE event_type = 'signup' GROUP BY 1)
    SELECT e.event_id, 'user' || e.user_id AS name, dim.known_id FROM events e
    LEFT JOIN dim ON dim.name = 'user' || e.user_id""")
def resolve_user(spark, sf_dir):
    """Every event's user looked up among those who signed up; NULL for the others."""
    events = frame(spark, sf_dir, "events").withColumn(
        "name", F.concat(F.lit("user"), F.col("user_id").cast("string"))
    )
    signed_up = events.filter("event_type = 'signup'").select("name", F.col("event_id").alias("known_id"))
    return resolve(events.select("event_id", "name"), signed_up, ["name"], "known_id")


@query(f"""WITH tags AS (SELECT DISTINCT trim(lower(p_type)) AS hashtag_text FROM part WHERE p_size > 10)
    SELECT p_partkey, trim(lower('  ' || p_type)) AS hashtag_text,
        CASE WHEN trim(lower(p_type)) IN (SELECT hashtag_text FROM tags)
             THEN {duck.hash_id("'hashtag'", 'trim(lower(p_type))')} END AS hashtag_id FROM part""")
def resolve_hashtag(spark, sf_dir):
    """Tag text normalized and looked up."""
    part = frame(spark, sf_dir, "part")
    text = F.trim(F.lower(F.concat(F.lit("  "), "p_type")))
    known = part.filter("p_size > 10").select(F.trim(F.lower("p_type")).alias("hashtag_text")).distinct()
    known = known.withColumn("hashtag_id", hash_id(F.lit("hashtag"), "hashtag_text"))
    return resolve(part.select("p_partkey", text.alias("hashtag_text")), known, ["hashtag_text"], "hashtag_id")


LIST_CHUNKS = 4


@query(f"""WITH t AS (SELECT unnest(string_split(p_name, ' ')) AS tag, p_partkey FROM part)
    SELECT tag, CAST({duck.hash_number('p_partkey')} % {LIST_CHUNKS} AS INTEGER) AS chunk,
        string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS ids
    FROM t GROUP BY ALL""")
def tag_ids(spark, sf_dir):
    """The parts of each word, in four chunks."""
    tagged = frame(spark, sf_dir, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("tag"))
    lists = id_lists(tagged, "tag", "p_partkey", LIST_CHUNKS)
    return lists.select("tag", "chunk", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


@query("""SELECT user_id, max(event_id) AS user_ref FROM events WHERE event_type = 'view' GROUP BY user_id
    UNION ALL SELECT user_id, max(event_id) FROM events WHERE event_type <> 'view' AND user_id NOT IN
        (SELECT user_id FROM events WHERE event_type = 'view') GROUP BY user_id""", name="last_writer")
def last_writer_wins(spark, sf_dir):
    """Key maps of two batches merged; the later batch overwrites the earlier."""
    events = frame(spark, sf_dir, "events").withColumnRenamed("event_id", "user_ref")
    return last_writer(
        [events.filter("event_type <> 'view'"), events.filter("event_type = 'view'")], "user_id", "user_ref"
    )


@query(f"""SELECT event_type, coalesce(min(CASE WHEN event_id % 7 = 0 OR event_type = 'error' THEN NULL
        ELSE CAST(ts AS DATE) END), CAST({AS_OF_SQL} AS DATE)) - 1 AS first_date FROM events GROUP BY 1""")
def min_post_date(spark, sf_dir):
    """The day before the first comment of each platform; texts that are no date do not count.

    One platform has none that is, and takes the day of the run.
    """
    no_date = (F.col("event_id") % 7 == 0) | (F.col("event_type") == "error")
    texts = frame(spark, sf_dir, "events").select(
        "event_type", F.when(no_date, "00 soon").otherwise(F.to_date("ts").cast("string")).alias("day")
    )
    return first_date(texts, "day", AS_OF, by=["event_type"])


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_vals(spark, sf_dir):
    return frame(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events)")
def dedup_rows(spark, sf_dir):
    """Whole rows that occur twice, once each."""
    events = frame(spark, sf_dir, "events")
    return events.union(events).dropDuplicates()


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 30""", name="preview")
def preview_rows(spark, sf_dir):
    """The 30 dearest lines in a total order."""
    lines = frame(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return preview(
        lines, 30,
        [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    )


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat_ws('|', '7', o_orderkey)), o_orderkey
    LIMIT 50""", name="sample_rows")
def sample_of_rows(spark, sf_dir):
    """Fifty orders drawn by a seeded hash."""
    return sample_rows(frame(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 50, 7, "o_orderkey")


@query("""SELECT event_id, user_id AS user_posted, CAST(ts AS DATE) AS comment_date, props AS comment_text,
    event_type AS comment_user FROM events""", name="harmonize")
def harmonize_names(spark, sf_dir):
    """Renames by map: the first source that applies takes the target name."""
    raw = frame(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("post_user"),
        F.to_date("ts").alias("post_date_created"),
        F.col("props").alias("comment"),
        F.col("event_type").alias("comment_user"),
    )
    return harmonize(raw, RENAMES)


@query("""SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(CAST(ts AS DATE) - 1 AS DATE) AS day_before FROM events""")
def post_date_shift(spark, sf_dir):
    """Integer date key, and the date moved back by a day: two platforms of bronze cleaned by one run, two by the next."""
    folder = scratch_folder(spark, "shift")
    posts = frame(spark, sf_dir, "events").select(
        "event_id", date_key("ts").alias("date_key"), F.to_date("ts").alias("post_date"), F.col("event_type").alias("platform")
    )
    first = F.col("platform").isin("click", "view")
    for rows in (posts.filter(first), posts.filter(~first)):
        replace_partitions(rows, f"{folder}/bronze/dim_posts", "platform")
        cleaners = {"dim_posts": lambda found: clean_posts(found, days_back=1)}
        refresh_silver(spark, f"{folder}/bronze", f"{folder}/silver", cleaners=cleaners)
    cleaned = read_table(spark, f"{folder}/silver/dim_posts")
    return cleaned.select("event_id", "date_key", F.col("post_date").alias("day_before"))
