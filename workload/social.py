"""Social media: entities across platforms, silver tables per platform, the gold star."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tillwater.plans import platforms, social_entities, social_star
from tillwater.sources.files import delete, scratch_folder
from tillwater.sources.tables import at_once, publish, read_table, stage
from workload import duck
from workload.columns import AS_OF, INSTAGRAM_HANDLE, TIKTOK_HANDLE, TWITTER_NAME
from workload.registry import query
from workload.standins import ctes, frame

PLATFORM_FILES = ["Facebook", "Instagram", "TikTok", "Twitter"]

# The raw rows of all platforms under common names.
UNIFIED = """
SELECT 'Facebook' AS platform, 0 AS place, user_url AS user_posted, post_url, post_id, url,
    date_created AS comment_date, CAST(NULL AS VARCHAR) AS hashtag_comment,
    CAST(NULL AS VARCHAR) AS tagged_user_in, CAST(NULL AS VARCHAR) AS tagged_users FROM facebook_csv
UNION ALL
SELECT 'Instagram', 1, post_user, post_url, post_id, url, comment_date, hashtag_comment, tagged_user_in, NULL
FROM instagram_csv
UNION ALL
SELECT 'TikTok', 2, commenter_url, post_url, post_id, url, date_created, NULL, NULL, NULL FROM tiktok_csv
UNION ALL
SELECT 'Twitter', 3, user_posted, NULL, NULL, url, NULL, NULL, NULL, tagged_users FROM twitter_csv"""

RAW = ("facebook_csv", "instagram_csv", "tiktok_csv", "twitter_csv")
USER_NAME = duck.last_segment("user_posted")
USER_ID = duck.hash_id("platform", USER_NAME)


def _unified(spark, sf_dir):
    return social_entities.unify(
        {name: frame(spark, sf_dir, f"{name.lower()}_csv") for name in PLATFORM_FILES}
    )


@query(ctes(*RAW, unified=UNIFIED) + f"""
    SELECT DISTINCT {USER_ID} AS user_id, {USER_NAME} AS display_name, 'Người dùng từ ' || platform AS bio,
        true AS is_verified, CAST(NULL AS BIGINT) AS followers_count, CAST(NULL AS BIGINT) AS following_count,
        CAST(NULL AS BIGINT) AS post_count, platform AS type_of_account
    FROM unified WHERE {USER_NAME} IS NOT NULL""")
def social_users(spark, sf_dir):
    return social_entities.users(_unified(spark, sf_dir))


FOUND_POSTS = f"""SELECT platform,
        coalesce(nullif(post_id, ''), {duck.last_segment('url')}, {duck.last_segment('post_url')}) AS post_id,
        {USER_ID} AS user_id, post_url, comment_date FROM unified WHERE platform <> 'Twitter'"""


@query(ctes(*RAW, unified=UNIFIED, found=FOUND_POSTS,
       dates="""SELECT platform, CAST(min(TRY_CAST(comment_date AS TIMESTAMP)) AS DATE) - 1 AS post_date
        FROM unified GROUP BY platform""") + f"""
    SELECT p.platform, p.post_id, p.user_id, CAST(NULL AS VARCHAR) AS post_content, d.post_date, p.post_url
    FROM ({duck.first_row('*', "(SELECT * FROM found WHERE trim(post_id) <> '')", 'platform, post_id',
                          'user_id NULLS LAST, post_url NULLS LAST')}) p
    JOIN dates d ON p.platform = d.platform""")
def social_posts(spark, sf_dir):
    return social_entities.posts(_unified(spark, sf_dir), AS_OF)


@query(ctes(*RAW, unified=UNIFIED, found=FOUND_POSTS)
       + "SELECT platform, user_id, post_url, comment_date FROM found WHERE coalesce(trim(post_id), '') = ''")
def social_posts_rejected(spark, sf_dir):
    """Posts without any id stay rows of their own."""
    return social_entities.rejected_posts(_unified(spark, sf_dir))


TAG_TEXT = "trim(lower(hashtag_comment))"


@query(ctes(*RAW, unified=UNIFIED) + f"""
    SELECT DISTINCT platform, {TAG_TEXT} AS hashtag_text, {duck.hash_id('platform', TAG_TEXT)} AS hashtag_id
    FROM unified WHERE hashtag_comment IS NOT NULL""")
def social_hashtags(spark, sf_dir):
    return social_entities.hashtags(_unified(spark, sf_dir))


@query(ctes(*RAW, unified=UNIFIED) + f"""
    SELECT DISTINCT platform, {duck.last_segment('post_url')} AS post_id, {duck.hash_id('platform', TAG_TEXT)} AS hashtag_id
    FROM unified WHERE post_url IS NOT NULL AND hashtag_comment IS NOT NULL""")
def social_post_hashtags(spark, sf_dir):
    return social_entities.post_hashtags(_unified(spark, sf_dir))


# Twitter rows have no post_url, so their mentions join in through another stand-in below.
MENTIONS = f"""
    SELECT DISTINCT platform, post_id, mentioned_user_id FROM (
        SELECT n.place, n.platform, n.post_id, n.name, arg_max(d.user_id, d.place) AS mentioned_user_id
        FROM named n LEFT JOIN directory d ON d.name = n.name AND d.place <= n.place
        GROUP BY n.place, n.platform, n.post_id, n.name)"""
DIRECTORY = f"""SELECT DISTINCT place, {USER_NAME} AS name, {USER_ID} AS user_id FROM unified
    WHERE {USER_NAME} IS NOT NULL"""
NAMED = f"""SELECT DISTINCT place, platform, {duck.last_segment('post_url')} AS post_id,
        {duck.last_segment('trim(mention)')} AS name
    FROM (SELECT place, platform, post_url, unnest([tagged_user_in, tagged_users]) AS mention FROM unified
          WHERE post_url IS NOT NULL) WHERE mention IS NOT NULL"""


@query(ctes(*RAW, unified=UNIFIED.replace("user_posted, NULL, NULL, url", "user_posted, url, NULL, url"),
            named=NAMED, directory=DIRECTORY) + MENTIONS)
def mentions(spark, sf_dir):
    """Mentions of all platforms; here the Twitter file names its posts by post_url too."""
    raw = {name: frame(spark, sf_dir, f"{name.lower()}_csv") for name in PLATFORM_FILES}
    raw["Twitter"] = raw["Twitter"].withColumn("post_url", F.col("url"))
    return social_entities.mentions(social_entities.unify(raw))


# --- silver per platform --------------------------------------------------------------

def _silver_user(name: str, source: str, user_id: str, display: str, biography: str) -> str:
    rows = f"""SELECT CAST({user_id} AS VARCHAR) AS user_id, {display} AS display_name,
        {biography} AS biography FROM {source}"""
    first = duck.first_row(
        "*", f"({rows})", "user_id", "display_name NULLS LAST, biography NULLS LAST"
    )
    return f"""SELECT user_id, display_name, biography, true AS is_verified, CAST(NULL AS INTEGER) AS following,
        CAST(NULL AS INTEGER) AS followed, CAST(NULL AS INTEGER) AS post, '{name}' AS user_type FROM ({first})"""


URL_ID = "coalesce(comment_user_url, '')"
SHOP_URL = "coalesce(commenter_url, '')"
X_NAME = TWITTER_NAME.format(duck.fallback_name("coalesce(user_posted, '')"))
FACEBOOK_USERS = _silver_user("Facebook", "facebook", "user_id", "user_name", "user_url")
INSTAGRAM_USERS = _silver_user(
    "Instagram", "instagram", duck.hash_id("'Instagram'", URL_ID),
    INSTAGRAM_HANDLE.replace("'|', CAST(comment_user AS VARCHAR)", f"'|', {URL_ID}").replace(
        "trim(comment_user_url)", f"trim({URL_ID})"),
    URL_ID,
)
TIKTOK_USERS = _silver_user(
    "TikTok", "tiktok", duck.hash_id("'TikTok'", SHOP_URL),
    TIKTOK_HANDLE.format(duck.fallback_name(SHOP_URL)), SHOP_URL,
)
TWITTER_USERS = _silver_user(
    "Twitter", "twitter", duck.hash_id("'Twitter'", X_NAME), X_NAME,
    f"'http://x.com/' || lower(replace({X_NAME}, ' ', ''))",
)


@query(ctes("facebook", "instagram", "tiktok", "twitter")
       + " UNION ALL ".join([FACEBOOK_USERS, INSTAGRAM_USERS, TIKTOK_USERS, TWITTER_USERS]))
def platform_users(spark, sf_dir):
    """Users of all four platforms in one layout."""
    return _silver(spark, sf_dir)["user"]


def _silver(spark, sf_dir):
    bronze = {name: frame(spark, sf_dir, name) for name in platforms.PLATFORMS}
    return platforms.silver_tables(bronze, AS_OF)


def _silver_posts(name: str, source: str, post_id: str, user_id: str, content: str, url: str) -> str:
    return f"""SELECT CAST({post_id} AS VARCHAR) AS post_id, CAST({user_id} AS VARCHAR) AS user_id,
        CAST({content} AS VARCHAR) AS post_content, TIMESTAMP '2024-01-31 00:00:00' AS post_date,
        {url} AS post_url, '{name}' AS post_type FROM {source}"""


POST_ORDER = ("user_id NULLS LAST, post_content NULLS LAST, post_date, post_url NULLS LAST, post_type NULLS LAST")
HAS_ID = "(SELECT * FROM rows WHERE trim(post_id) <> '')"
FACEBOOK_POST = f"coalesce(nullif(post_id, ''), {duck.last_segment('post_url')})"
EACH_POST = [
    _silver_posts("Facebook", "facebook", FACEBOOK_POST, "user_id", "NULL", "post_url"),
    _silver_posts("Instagram", "instagram", "post_id", duck.hash_id("'Instagram'", URL_ID), "NULL", "post_url"),
    _silver_posts("TikTok", "tiktok", "post_id", duck.hash_id("'TikTok'", SHOP_URL), "NULL", "post_url"),
    _silver_posts("Twitter", "twitter", "id", duck.hash_id("'Twitter'", X_NAME), "description", "url"),
]


@query(ctes("facebook", "instagram", "tiktok", "twitter", rows=" UNION ALL ".join(EACH_POST))
       + duck.first_row("post_id, user_id, post_content, post_date, post_url, post_type", HAS_ID,
                        "post_type, post_id", POST_ORDER))
def platform_posts(spark, sf_dir):
    """Posts of all four platforms, one row per platform and id."""
    return _silver(spark, sf_dir)["post"]


@query(ctes("facebook", "instagram", "tiktok", "twitter") + " UNION ALL ".join(
    f"SELECT '{name}' AS post_type, count(DISTINCT nullif(trim(CAST({post_id} AS VARCHAR)), '')) AS posts FROM {source}"
    for name, source, post_id in (
        ("Facebook", "facebook", FACEBOOK_POST), ("Instagram", "instagram", "post_id"),
        ("TikTok", "tiktok", "post_id"), ("Twitter", "twitter", "id"))))
def platform_post_counts(spark, sf_dir):
    """How many posts of each platform silver holds: as many as the platform has different ids."""
    return _silver(spark, sf_dir)["post"].groupBy("post_type").agg(F.count(F.lit(1)).alias("posts"))


@query(ctes("facebook", "instagram", "tiktok", "twitter", rows=" UNION ALL ".join(EACH_POST))
       + "SELECT * FROM rows WHERE coalesce(trim(post_id), '') = ''")
def platform_rejected(spark, sf_dir):
    """Posts without any id."""
    return _silver(spark, sf_dir)["post_rejected"]


TAGGED = f"""SELECT DISTINCT 'Instagram' AS post_type, CAST(post_id AS VARCHAR) AS post_id, trim(lower(tag)) AS hashtag_text
    FROM (SELECT post_id, unnest({duck.tags('hashtag_comment', True)}) AS tag FROM instagram)"""
TAGGED_X = f"""SELECT DISTINCT 'Twitter' AS post_type, CAST(id AS VARCHAR) AS post_id, trim(lower(tag)) AS hashtag_text
    FROM (SELECT id, unnest({duck.tags('hashtags', False)}) AS tag FROM twitter)"""
TAG_ID = duck.hash_id("'hashtag'", "hashtag_text")


@query(ctes("instagram", "twitter", tagged=f"{TAGGED} UNION {TAGGED_X}")
       + f"SELECT DISTINCT {TAG_ID} AS hastag_id, hashtag_text FROM tagged")
def platform_hashtags(spark, sf_dir):
    return _silver(spark, sf_dir)["hashtag"]


@query(ctes("instagram", "twitter", tagged=f"{TAGGED} UNION {TAGGED_X}")
       + f"SELECT DISTINCT post_type, post_id, {TAG_ID} AS hashtag_id FROM tagged")
def platform_post_hashtags(spark, sf_dir):
    return _silver(spark, sf_dir)["post_hashtag"]


@query(ctes("instagram", "twitter", tagged=f"{TAGGED} UNION {TAGGED_X}", known=TAGGED_X)
       + f"""SELECT DISTINCT post_type, post_id, {TAG_ID} AS hashtag_id FROM tagged
       WHERE hashtag_text IN (SELECT hashtag_text FROM known)""")
def post_hashtag(spark, sf_dir):
    """Tags of both platforms joined by text to the hashtag table of one."""
    rows = platforms.platform_rows({n: frame(spark, sf_dir, n) for n in ("instagram", "twitter")}, AS_OF)
    known = platforms.hashtag_table(platforms.twitter(frame(spark, sf_dir, "twitter")).tagged)
    return platforms.link_hashtags(rows.tagged, known)


def _mentioned(kind: str, users: str, source: str, post_id: str, column: str) -> str:
    return f"""SELECT '{kind}' AS post_type, n.post_id, n.name AS mentioned_name, d.user_id AS mentioned_user_id FROM (
        SELECT DISTINCT CAST({post_id} AS VARCHAR) AS post_id, {duck.last_segment(f'trim({column})')} AS name
        FROM {source} WHERE {column} IS NOT NULL AND {column} <> 'unknown') n
      LEFT JOIN (SELECT display_name AS name, min(user_id) AS user_id FROM ({users}) GROUP BY 1) d ON d.name = n.name
      WHERE n.name IS NOT NULL"""


MENTIONED = (_mentioned("Instagram", INSTAGRAM_USERS, "instagram", "post_id", "tagged_users_in_comment") + " UNION ALL "
             + _mentioned("Twitter", TWITTER_USERS, "twitter", "id", "tagged_users"))


@query(ctes("instagram", "twitter") + MENTIONED)
def platform_mentions(spark, sf_dir):
    return _silver(spark, sf_dir)["user_mentions"]


# Which rows of bronze came in on the second day.
LATE_ROWS = {
    "facebook": "date_created >= '2024-01-15'", "instagram": "comment_date >= '2024-01-15'",
    "tiktok": "coalesce(post_date_created, '') >= '2024-01-15'", "twitter": "coalesce(date_posted, '') >= '2024-01-15'",
}


def _silver_twice(spark, sf_dir, name):
    """A silver table after two days of bronze, each folded in by a run of its own."""
    folder = scratch_folder(spark, "silver-twice")
    for day, late in (("2024-02-01", "NOT ({})"), ("2024-02-02", "{}")):

        def land(platform, condition):
            rows = frame(spark, sf_dir, platform).filter(late.format(condition))
            stamped = rows.withColumns({"ingestion_time": F.lit(day).cast("timestamp"), "ingestion_date": F.lit(day).cast("date")})
            publish(stamped, f"{folder}/bronze/{platform}", "append", partition_by=["ingestion_date"], gathered=False)

        at_once(spark, [partial(land, *rows) for rows in LATE_ROWS.items()])
        platforms.refresh_silver(spark, f"{folder}/bronze", f"{folder}/silver", as_of=day, layout=["bucket_of_4"])
    return read_table(spark, f"{folder}/silver/{name}").drop("ingestion_date")


EACH_DATED_POST = " UNION ALL ".join(
    rows.replace("TIMESTAMP '2024-01-31 00:00:00'",
                 f"CASE WHEN {late} THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-31 00:00:00' END")
    for rows, late in zip(EACH_POST, LATE_ROWS.values())
)


@query(ctes("facebook", "instagram", "tiktok", "twitter", rows=EACH_DATED_POST)
       + duck.first_row("post_id, user_id, post_content, post_date, post_url, post_type", HAS_ID,
                        "post_type, post_id", f"post_date, {POST_ORDER}"))
def platform_posts_twice(spark, sf_dir):
    """Posts after two runs: the second reads its own day only, and leaves the dates of known posts alone."""
    return _silver_twice(spark, sf_dir, "post")


@query(ctes("instagram", "twitter") + MENTIONED)
def platform_mentions_twice(spark, sf_dir):
    """Mentions after two runs: names that were not known at first are resolved when their users come in."""
    return _silver_twice(spark, sf_dir, "user_mentions")


# --- gold star ------------------------------------------------------------------------

@query(ctes("silver_users") + """SELECT user_id, display_name, biography, is_verified, followed AS followers_count,
    following AS following_count, post AS posts_count, CAST(NULL AS VARCHAR) AS profile_image_url,
    coalesce(user_type = 'product', false) AS contains_product FROM silver_users""")
def dim_user(spark, sf_dir):
    return social_star.dim_user(frame(spark, sf_dir, "silver_users"))


@query(ctes("silver_posts") + """SELECT post_id, user_id, post_content, post_url, post_type,
    CAST(NULL AS VARCHAR) AS external_url, post_date AS created_at, false AS contains_product,
    CAST(NULL AS VARCHAR) AS product_categories FROM silver_posts""")
def dim_post(spark, sf_dir):
    return social_star.dim_post(frame(spark, sf_dir, "silver_posts"))


@query(ctes("post_links") + """SELECT DISTINCT CAST(hashtag_id AS VARCHAR) AS hashtag_id,
    'tag ' || hashtag_id AS hashtag_text, false AS is_shopping_related FROM post_links""")
def dim_hashtag(spark, sf_dir):
    links = frame(spark, sf_dir, "post_links")
    tag = F.concat(F.lit("tag "), F.col("hashtag_id").cast("string"))
    hashtags = links.select(F.col("hashtag_id").alias("hastag_id"), tag.alias("hashtag_text")).distinct()
    return social_star.dim_hashtag(hashtags)


DATES = """SELECT d AS full_date, CAST(row_number() OVER (ORDER BY d NULLS FIRST) AS INTEGER) AS date_id
    FROM (SELECT DISTINCT CAST(post_date AS DATE) AS d FROM {}) """
DATED = """SELECT p.post_type, p.post_id, d.date_id FROM (
        SELECT post_type, post_id, min(CAST(post_date AS DATE)) AS d FROM {} GROUP BY post_type, post_id) p
    LEFT JOIN dates d ON d.full_date = p.d"""


@query(ctes("silver_posts") + DATES.format("silver_posts"))
def date_ids(spark, sf_dir):
    return social_star.dim_date(frame(spark, sf_dir, "silver_posts"))


def _star_twice(spark, sf_dir, name):
    """A gold table after two runs: posts and links of the first days, then those that came in since.

    A link may come in before or after its post, and one id stands for posts of two platforms.
    """
    folder = scratch_folder(spark, "gold-twice")
    first = frame(spark, sf_dir, "repeated_posts").groupBy("post_type", "post_id").agg(F.min("post_date").alias("post_date"))
    posts = first.select(
        "post_id", F.lit("u").alias("user_id"), F.lit("text").alias("post_content"), "post_date",
        F.lit("url").alias("post_url"), "post_type",
        F.when(F.col("post_date") < "2024-01-10", F.lit("2024-02-01")).otherwise("2024-02-08").cast("date").alias("ingestion_date"),
    )
    links = frame(spark, sf_dir, "post_links").withColumn(
        "ingestion_date", F.when(F.col("hashtag_id") < 25, F.lit("2024-02-01")).otherwise("2024-02-08").cast("date")
    )
    tag = F.concat(F.lit("tag "), F.col("hashtag_id").cast("string"))
    # both runs publish of it
    posts, staged = stage(posts, "posts")
    tables = {
        "user": frame(spark, sf_dir, "silver_users").withColumn("ingestion_date", F.lit("2024-02-01").cast("date")),
        "post": posts,
        "hashtag": links.groupBy(F.col("hashtag_id").alias("hastag_id"), tag.alias("hashtag_text")).agg(
            F.min("ingestion_date").alias("ingestion_date")
        ),
        "post_hashtag": links.select("post_type", "post_id", "hashtag_id", "ingestion_date"),
        "user_mentions": links.filter("mentioned_name IS NOT NULL").select(
            "post_type", "post_id", "mentioned_name", "mentioned_user_id", "ingestion_date"
        ),
    }
    for since, rows in ((None, "ingestion_date < '2024-02-08'"), ("2024-02-08", "true")):
        at_once(spark, [partial(publish, all_rows.filter(rows), f"{folder}/silver/{table}") for table, all_rows in tables.items()])
        social_star.refresh_gold(spark, f"{folder}/silver", f"{folder}/gold", since=since, layout=["bucket_of_4"])
    delete(spark, staged)
    return read_table(spark, f"{folder}/gold/{name}")


# Days of the first run keep their ids, the others are numbered above.
DATES_TWICE = """SELECT d AS full_date, CAST(row_number() OVER (ORDER BY late, d) AS INTEGER) AS date_id FROM (
    SELECT CAST(post_date AS DATE) AS d, min(CASE WHEN post_date < TIMESTAMP '2024-01-10' THEN 0 ELSE 1 END) AS late
    FROM first_posts WHERE post_date IS NOT NULL GROUP BY 1)"""
FIRST_POSTS = "SELECT post_type, post_id, min(post_date) AS post_date FROM repeated_posts GROUP BY post_type, post_id"


@query(ctes("repeated_posts", first_posts=FIRST_POSTS) + DATES_TWICE)
def date_ids_twice(spark, sf_dir):
    """Date ids after a second run of the gold step: the first run's days keep theirs."""
    return _star_twice(spark, sf_dir, "dim_date")


def _dated(spark, sf_dir):
    posts = frame(spark, sf_dir, "repeated_posts")
    return social_star.post_dates(posts, social_star.dim_date(posts))


STAR = ctes("post_links", "repeated_posts", dates=DATES.format("repeated_posts"), dated=DATED.format("repeated_posts"))
STAR_TWICE = ctes("post_links", "repeated_posts", first_posts=FIRST_POSTS, dates=DATES_TWICE, dated=DATED.format("first_posts"))
USAGE = """SELECT l.post_type || '_' || l.post_id || '_' || l.hashtag_id AS usage_id, l.post_type, l.post_id, l.hashtag_id,
    d.date_id, 1 AS usage_count FROM post_links l LEFT JOIN dated d ON d.post_id = l.post_id AND d.post_type = l.post_type"""
MENTIONED_POSTS = """SELECT l.post_type || '_' || l.post_id || '_' || l.mentioned_user_id AS mention_id, l.post_type, l.post_id,
    l.mentioned_name, l.mentioned_user_id, d.date_id
    FROM post_links l LEFT JOIN dated d ON d.post_id = l.post_id AND d.post_type = l.post_type"""


@query(STAR + "SELECT * FROM dated")
def post_dates(spark, sf_dir):
    """Date id of every post; posts occur more than once, and on two platforms under one id."""
    return _dated(spark, sf_dir)


@query(STAR + USAGE)
def hashtag_usage(spark, sf_dir):
    links = frame(spark, sf_dir, "post_links").select("post_type", "post_id", "hashtag_id")
    return social_star.hashtag_usage(links, _dated(spark, sf_dir))


@query(STAR_TWICE + USAGE)
def hashtag_usage_twice(spark, sf_dir):
    return _star_twice(spark, sf_dir, "fact_hashtag_usage")


@query(STAR + MENTIONED_POSTS)
def user_mention(spark, sf_dir):
    links = frame(spark, sf_dir, "post_links").select("post_type", "post_id", "mentioned_name", "mentioned_user_id")
    return social_star.user_mention(links, _dated(spark, sf_dir))


@query(STAR_TWICE + MENTIONED_POSTS + " WHERE l.mentioned_name IS NOT NULL")
def user_mention_twice(spark, sf_dir):
    return _star_twice(spark, sf_dir, "fact_user_mention")
