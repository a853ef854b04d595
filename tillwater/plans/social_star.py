"""Gold social star: user, post, hashtag and date dimensions, usage and mention facts.

A post is named by its platform and id, in the dimension and in the facts: one id may stand for
posts of two platforms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.text import composite_id
from tillwater.operators.aggregates import high_water
from tillwater.operators.keys import date_ids, dedup_on, lookup_join, only_new, require_key
from tillwater.operators.shape import typed_nulls
from tillwater.sources import files
from tillwater.sources.tables import FILE_FORMATS, at_once, publish, read_table, stage, table_exists, upsert_table

POST_KEYS = ["post_type", "post_id"]
DIMENSION_KEYS = {
    "dim_user": ["user_id"],
    "dim_post": POST_KEYS,
    "dim_hashtag": ["hashtag_id"],
    "dim_date": ["full_date"],
}
FACT_KEYS = {
    "fact_hashtag_usage": [*POST_KEYS, "hashtag_id"],
    "fact_user_mention": [*POST_KEYS, "mentioned_name"],
}
# How new gold tables are laid out; large ones take more buckets.
LAYOUT = ("bucket_of_16",)


def dim_user(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        "display_name",
        "biography",
        "is_verified",
        F.col("followed").alias("followers_count"),
        F.col("following").alias("following_count"),
        F.col("post").alias("posts_count"),
        *typed_nulls({"profile_image_url": "string"}),
        F.coalesce(F.col("user_type") == "product", F.lit(False)).alias("contains_product"),
    )


def dim_post(posts: DataFrame) -> DataFrame:
    return posts.select(
        "post_id",
        "user_id",
        "post_content",
        "post_url",
        "post_type",
        *typed_nulls({"external_url": "string"}),
        F.col("post_date").alias("created_at"),
        F.lit(False).alias("contains_product"),
        *typed_nulls({"product_categories": "string"}),
    )


def dim_hashtag(hashtags: DataFrame) -> DataFrame:
    return hashtags.select(
        F.col("hastag_id").cast("string").alias("hashtag_id"),
        "hashtag_text",
        F.lit(False).alias("is_shopping_related"),
    )


def dim_date(posts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every day of the posts with its id; days in ``known`` keep theirs, new ones go on above."""
    days = posts.select(F.to_date("post_date").alias("full_date"))
    if known is None:
        return date_ids(days)
    known = require_key(known.select("full_date", "date_id"), "full_date")
    added = date_ids(only_new(require_key(days, "full_date").distinct(), known, "full_date"))
    highest = high_water(known, "date_id").first()[0] or 0
    return known.unionByName(added.withColumn("date_id", (F.col("date_id") + highest).cast("int")))


def post_dates(posts: DataFrame, dates: DataFrame) -> DataFrame:
    """(post_type, post_id, date_id), one row per post: its earliest date; NULL without one.

    ``dates`` has one row per calendar day (at most 3.7 million, years 1 to 9999, a few
    bytes each), so it is broadcast; a shuffle would put all posts of a day together.
    """
    # ids need not be in the order of days, so the earliest day is found before its id
    first = posts.groupBy(*POST_KEYS).agg(F.min(F.to_date("post_date")).alias("full_date"))
    return first.join(F.broadcast(dates), "full_date", "left").select(*POST_KEYS, "date_id")


def hashtag_usage(post_hashtags: DataFrame, dated: DataFrame) -> DataFrame:
    """Keeps pairs whose post has no date or is not known."""
    links = post_hashtags.withColumn("post_id", F.col("post_id").cast("string"))
    return lookup_join(links, dated, POST_KEYS).select(
        composite_id(composite_id("post_type", "post_id"), "hashtag_id").alias("usage_id"),
        *POST_KEYS,
        "hashtag_id",
        "date_id",
        F.lit(1).alias("usage_count"),
    )


def user_mention(mentions: DataFrame, dated: DataFrame) -> DataFrame:
    """Keeps mentions whose post is not known; the user and the id are NULL for a name nobody has."""
    return lookup_join(mentions, dated, POST_KEYS).select(
        composite_id(composite_id("post_type", "post_id"), "mentioned_user_id").alias("mention_id"),
        *POST_KEYS,
        "mentioned_name",
        "mentioned_user_id",
        "date_id",
    )


def star(
    users: DataFrame,
    posts: DataFrame,
    hashtags: DataFrame,
    post_hashtags: DataFrame,
    mentions: DataFrame,
    known_dates: DataFrame | None = None,
) -> dict[str, DataFrame]:
    dates = dim_date(posts, known_dates)
    dated = post_dates(posts, dates)
    return {
        "dim_user": dim_user(users),
        "dim_post": dim_post(posts),
        "dim_hashtag": dim_hashtag(hashtags),
        "dim_date": dates,
        "fact_hashtag_usage": hashtag_usage(post_hashtags, dated),
        "fact_user_mention": user_mention(mentions, dated),
    }


def _came(since) -> Column:
    return F.coalesce(F.col("ingestion_date") >= F.lit(since).cast("date"), F.lit(False))


def _of_posts(links: DataFrame, posts: DataFrame, since, keys: Sequence[str]) -> DataFrame:
    """The links that came in, and the older ones of posts that did; one row per key."""
    theirs = lookup_join(links.filter(~_came(since)), posts.select(*POST_KEYS), POST_KEYS, "left_semi")
    return dedup_on(theirs.unionByName(links.filter(_came(since))).drop("ingestion_date"), keys)


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    fmt: str = "parquet",
    since=None,
    layout: Sequence[str] = LAYOUT,
) -> None:
    """Fold silver into the star: all of it, or what came in since the day of the last run.

    With ``since``, dimensions are upserted by the rows that came in, and facts by the links that
    came in and those of posts that did; of the other links only the post keys are read, and of
    the other posts only those that such links name.  Without it, facts are replaced.  Days that
    the date dimension holds keep their ids, and only new days are numbered, above the highest.
    """
    gold = gold_path.rstrip("/")
    silver = {
        name: read_table(spark, f"{silver_path.rstrip('/')}/{name}", fmt)
        for name in ("user", "post", "hashtag", "post_hashtag", "user_mentions")
    }
    came = {
        name: rows if since is None else rows.filter(_came(since))
        for name, rows in silver.items()
    }
    folders = []
    try:
        known = None
        if table_exists(spark, f"{gold}/dim_date"):
            # read once: the table is replaced below while the facts still look its ids up
            known, folder = stage(read_table(spark, f"{gold}/dim_date", fmt), "dates")
            folders.append(folder)
        dates, folder = stage(dim_date(came["post"], known), "dates")
        folders.append(folder)
        dimensions = {
            "dim_user": dim_user(came["user"]),
            "dim_post": dim_post(came["post"]),
            "dim_hashtag": dim_hashtag(came["hashtag"]),
            "dim_date": dates,
        }

        def fold(name: str, rows: DataFrame) -> None:
            keys = DIMENSION_KEYS[name]
            spread = layout if name != "dim_date" and fmt in FILE_FORMATS else ()
            upsert_table(spark, f"{gold}/{name}", require_key(rows, *keys), keys, fmt, spread)

        def link(name: str, links: str, fact: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
            keys, path = FACT_KEYS[name], f"{gold}/{name}"
            spread = layout if fmt in FILE_FORMATS else ()
            if since is None or not table_exists(spark, path):
                rows = fact(silver[links], post_dates(silver["post"], dates))
                publish(rows, path, "overwrite", fmt, replace_schema=True, partition_by=spread, keys=keys)
                return
            touched, folder = stage(_of_posts(silver[links], came["post"], since, keys), "links")
            folders.append(folder)
            theirs = lookup_join(silver["post"], touched.select(*POST_KEYS), POST_KEYS, "left_semi")
            upsert_table(spark, path, fact(touched, post_dates(theirs, dates)), keys, fmt, spread, check=False)

        at_once(spark, [partial(fold, name, rows) for name, rows in dimensions.items()], fmt)
        facts = (
            ("fact_hashtag_usage", "post_hashtag", hashtag_usage),
            ("fact_user_mention", "user_mentions", user_mention),
        )
        at_once(spark, [partial(link, *fact) for fact in facts], fmt)
    finally:
        for folder in folders:
            files.delete(spark, folder)
