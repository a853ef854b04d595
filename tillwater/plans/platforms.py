"""Silver users, posts, tags and mentions from each platform's bronze rows.

Each platform is a projection to common row layouts; the rows of all platforms are
unioned before the first shuffle, so each silver table is deduplicated once.  Every row says
which platform it is of and on which day it came in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.dates import days_before
from tillwater.functions.hashing import hash_id
from tillwater.functions.text import (
    NO_TAG, first_post_id, instagram_handle, last_segment, normalize, tags, tiktok_handle, twitter_name,
    twitter_profile,
)
from tillwater.operators.keys import dedup_on, least_per_key, lookup_join, resolve
from tillwater.operators.shape import align_union, typed_nulls
from tillwater.sources import files, manifest
from tillwater.sources.tables import (
    FILE_FORMATS, at_once, read_table, replace_partitions, stage, table_exists, upsert_table,
)

TAG_SCOPE = "hashtag"
# One id may stand for posts of two platforms.
POST_KEYS = ["post_type", "post_id"]
KEYS = {
    "user": ["user_type", "user_id"],
    "post": POST_KEYS,
    "hashtag": ["hashtag_text"],
    "post_hashtag": [*POST_KEYS, "hashtag_id"],
    "user_mentions": [*POST_KEYS, "mentioned_name"],
}
# Which of two rows of one key stays: the post that came first, the mention that was resolved last.
FIRST = {"post": "post_date ASC", "user_mentions": "ingestion_date DESC"}
# How new silver tables are laid out; large ones take more buckets.
LAYOUT = ("bucket_of_16",)


@dataclass
class PlatformRows:
    """Rows of one platform before deduplication; None where it has no such rows."""

    users: DataFrame
    posts: DataFrame
    tagged: DataFrame | None = None
    mentioned: DataFrame | None = None


def _first(name: str) -> list[Column]:
    """The order that :data:`FIRST` names, NULLs last."""
    if name not in FIRST:
        return []
    column, _, way = FIRST[name].partition(" ")
    return [F.col(column).asc_nulls_last() if way == "ASC" else F.col(column).desc_nulls_last()]


def _came(df: DataFrame, as_of) -> Column:
    """The day a row came in; ``as_of`` where rows do not say."""
    return F.to_date("ingestion_time" if "ingestion_time" in df.columns else days_before(as_of, 0)).alias("ingestion_date")


def _users(
    df: DataFrame, of: Sequence[str], user_id: Column, display_name: Column, biography: Column, user_type: str, as_of
) -> DataFrame:
    """The users of some rows, with few repeats: what the columns ``of`` hold is put together before ids are made of it."""
    return df.select(*of, _came(df, as_of)).distinct().select(
        user_id.cast("string").alias("user_id"),
        display_name.alias("display_name"),
        biography.alias("biography"),
        F.lit(True).alias("is_verified"),
        *typed_nulls({"following": "int", "followed": "int", "post": "int"}),
        F.lit(user_type).alias("user_type"),
        "ingestion_date",
    )


def _posts(
    df: DataFrame, post_id: Column, user_id: Column, content: Column, url: Column, kind: str, as_of
) -> DataFrame:
    """The day before a row came in stands for the unknown date of a post.

    Rows without an ingestion time take the day before ``as_of``.
    """
    if "ingestion_time" in df.columns:
        dated = F.col("ingestion_time") - F.expr("INTERVAL 1 DAY")
    else:
        dated = days_before(as_of, 1)
    return df.select(
        post_id.cast("string").alias("post_id"),
        user_id.cast("string").alias("user_id"),
        content.cast("string").alias("post_content"),
        dated.alias("post_date"),
        url.alias("post_url"),
        F.lit(kind).alias("post_type"),
        _came(df, as_of),
    )


def tagged_posts(df: DataFrame, post_id: Column, tag_list: str, bracketed: bool, kind: str, as_of) -> DataFrame:
    """(post_type, post_id, hashtag_text, ingestion_date) with normalized text, one row per tag of a list."""
    exploded = df.select(
        F.lit(kind).alias("post_type"), post_id.cast("string").alias("post_id"),
        F.explode(tags(tag_list, bracketed)).alias("tag"), _came(df, as_of),
    )
    return exploded.select("post_type", "post_id", normalize("tag").alias("hashtag_text"), "ingestion_date")


def hashtag_table(tagged: DataFrame) -> DataFrame:
    return tagged.select("hashtag_text").distinct().select(
        _hashtag_id().alias("hastag_id"), "hashtag_text"
    )


def _hashtag_id() -> Column:
    return hash_id(F.lit(TAG_SCOPE), "hashtag_text")


def link_hashtags(tagged: DataFrame, hashtags: DataFrame) -> DataFrame:
    """(post_type, post_id, hashtag_id) for the tags that a given hashtag table holds, by equal text.

    The table has one row per text, so a tag that a third of all posts use can be split.
    """
    ids = hashtags.select("hashtag_text", F.col("hastag_id").alias("hashtag_id"))
    pairs = tagged.select(*POST_KEYS, "hashtag_text").distinct()
    return lookup_join(pairs, ids, ["hashtag_text"], "inner").select(*POST_KEYS, "hashtag_id")


def _mentioned(df: DataFrame, post_id: Column, columns: Sequence[str], kind: str, as_of) -> DataFrame:
    exploded = df.select(
        F.lit(kind).alias("post_type"), post_id.cast("string").alias("post_id"),
        F.explode(F.array(*columns)).alias("mention"), _came(df, as_of),
    )
    return exploded.filter(F.col("mention").isNotNull() & (F.col("mention") != NO_TAG)).select(
        *POST_KEYS, last_segment(F.trim("mention")).alias("mentioned_name"), "ingestion_date"
    ).filter(F.col("mentioned_name").isNotNull())


def resolve_mentions(mentioned: DataFrame, users: DataFrame) -> DataFrame:
    """One row per post and name with the user of the post's platform; unknown names give NULL."""
    return _resolved(least_per_key(mentioned, KEYS["user_mentions"]), users)


def _resolved(mentioned: DataFrame, users: DataFrame) -> DataFrame:
    names = users.select(F.col("user_type").alias("post_type"), F.col("display_name").alias("mentioned_name"), "user_id")
    found = resolve(mentioned, names, ["post_type", "mentioned_name"], "user_id")
    return found.select(*KEYS["user_mentions"], F.col("user_id").alias("mentioned_user_id"), "ingestion_date")


def facebook(df: DataFrame, as_of=None) -> PlatformRows:
    name, user_id = "Facebook", F.col("user_id")
    post_id = first_post_id(F.col("post_id").cast("string"), F.lit(None).cast("string"), "post_url")
    return PlatformRows(
        users=_users(df, ["user_id", "user_name", "user_url"], user_id, F.col("user_name"), F.col("user_url"), name, as_of),
        posts=_posts(df, post_id, user_id, F.lit(None), F.col("post_url"), name, as_of),
    )


def instagram(df: DataFrame, as_of=None) -> PlatformRows:
    name, post_id = "Instagram", F.col("post_id")
    url = F.coalesce("comment_user_url", F.lit(""))
    user_id = hash_id(F.lit(name), url)
    return PlatformRows(
        users=_users(df, ["comment_user_url"], user_id, instagram_handle(url, url), url, name, as_of),
        posts=_posts(df, post_id, user_id, F.lit(None), F.col("post_url"), name, as_of),
        tagged=tagged_posts(df, post_id, "hashtag_comment", True, name, as_of),
        mentioned=_mentioned(df, post_id, ["tagged_users_in_comment"], name, as_of),
    )


def tiktok(df: DataFrame, as_of=None) -> PlatformRows:
    name, url = "TikTok", F.coalesce("commenter_url", F.lit(""))
    user_id = hash_id(F.lit(name), url)
    return PlatformRows(
        users=_users(df, ["commenter_url"], user_id, tiktok_handle(url, url), url, name, as_of),
        posts=_posts(df, F.col("post_id"), user_id, F.lit(None), F.col("post_url"), name, as_of),
    )


def twitter(df: DataFrame, as_of=None) -> PlatformRows:
    """The only platform whose rows are the posts themselves, with their text."""
    name, post_id = "Twitter", F.col("id")
    display_name = twitter_name("user_posted", F.coalesce("user_posted", F.lit("")))
    user_id = hash_id(F.lit(name), display_name)
    return PlatformRows(
        users=_users(df, ["user_posted"], user_id, display_name, twitter_profile(display_name), name, as_of),
        posts=_posts(df, post_id, user_id, F.col("description"), F.col("url"), name, as_of),
        tagged=tagged_posts(df, post_id, "hashtags", False, name, as_of),
        mentioned=_mentioned(df, post_id, ["tagged_users"], name, as_of),
    )


PLATFORMS = {"facebook": facebook, "instagram": instagram, "tiktok": tiktok, "twitter": twitter}


def platform_rows(bronze: Mapping[str, DataFrame], as_of=None) -> PlatformRows:
    """The rows of the given platforms together."""
    parts = [PLATFORMS[name](df, as_of) for name, df in bronze.items()]

    def together(frames: list[DataFrame | None]) -> DataFrame | None:
        present = [df for df in frames if df is not None]
        return align_union(*present) if present else None

    return PlatformRows(
        users=together([p.users for p in parts]),
        posts=together([p.posts for p in parts]),
        tagged=together([p.tagged for p in parts]),
        mentioned=together([p.mentioned for p in parts]),
    )


def batch_tables(rows: PlatformRows) -> dict[str, DataFrame]:
    """The silver tables of some rows, one row per key, with the day it came in.

    A tag's id is a hash of its text, so the post-hashtag pairs need no join here.  Of a
    post's rows the one that came first counts, so later runs leave its date alone.  Posts
    without any id cannot be told apart and go to ``post_rejected``, each row as it is.
    """
    has_id = F.coalesce(F.trim("post_id") != "", F.lit(False))
    tables = {
        # a user has many equal rows, one per comment
        "user": least_per_key(rows.users, KEYS["user"]),
        "post": dedup_on(rows.posts.filter(has_id), POST_KEYS, _first("post")),
        "post_rejected": rows.posts.filter(~has_id),
    }
    if rows.tagged is not None:
        tagged = rows.tagged.withColumn("hashtag_id", _hashtag_id())
        tables["hashtag"] = tagged.groupBy(F.col("hashtag_id").alias("hastag_id"), "hashtag_text").agg(
            F.min("ingestion_date").alias("ingestion_date")
        )
        tables["post_hashtag"] = tagged.groupBy(*KEYS["post_hashtag"]).agg(F.min("ingestion_date").alias("ingestion_date"))
    return tables


def silver_tables(bronze: Mapping[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The silver tables of all rows of the given platforms, without the days they came in."""
    rows = platform_rows(bronze, as_of)
    tables = batch_tables(rows)
    if rows.mentioned is not None:
        tables["user_mentions"] = resolve_mentions(rows.mentioned, rows.users)
    return {name: table.drop("ingestion_date") for name, table in tables.items()}


def _fold(spark: SparkSession, path: str, batch: DataFrame, name: str, fmt: str, layout: Sequence[str]) -> None:
    """Add a batch to a silver table; of two rows of one key the one that :func:`batch_tables` would choose stays."""
    keys = KEYS[name]
    least = lambda rows: dedup_on(rows, keys, _first(name))
    if fmt in FILE_FORMATS:
        upsert_table(
            spark, path, batch, keys, fmt, layout, check=False, merge=lambda target, source: least(target.unionByName(source))
        )
    else:
        if table_exists(spark, path):
            batch = least(batch.unionByName(lookup_join(read_table(spark, path, fmt), batch.select(*keys), keys, "left_semi")))
        upsert_table(spark, path, batch, keys, fmt, check=False)


def _open_mentions(spark: SparkSession, silver: str, rows: PlatformRows, fmt: str, as_of) -> DataFrame:
    """The mentions of a batch, and the stored ones whose name a user of the batch has."""
    if not table_exists(spark, f"{silver}/user_mentions"):
        return rows.mentioned
    named = rows.users.select(F.col("user_type").alias("post_type"), F.col("display_name").alias("mentioned_name")).distinct()
    stored = read_table(spark, f"{silver}/user_mentions", fmt)
    # their facts change with this run
    again = lookup_join(stored, named, ["post_type", "mentioned_name"], "left_semi").select(
        *KEYS["user_mentions"], F.to_date(days_before(as_of, 0)).alias("ingestion_date")
    )
    return again if rows.mentioned is None else rows.mentioned.unionByName(again)


def refresh_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, fmt: str = "parquet", as_of=None,
    layout: Sequence[str] = LAYOUT,
) -> dict[str, list[str]]:
    """Fold the days of bronze that are new or changed since the last run into the silver tables.

    A manifest beside them says which days earlier runs have folded in; these are not read again.
    Tables are upserted by key, in the buckets that the batch falls in.  A mention whose name nobody
    had is resolved when the user comes in.  Returns the days by platform; a run that was cut
    short folds its days in again, which changes nothing twice.
    """
    bronze, silver = bronze_path.rstrip("/"), silver_path.rstrip("/")
    notes = f"{silver}/manifest"
    todo = {name: manifest.pending(spark, notes, name, f"{bronze}/{name}", "ingestion_date") for name in PLATFORMS}
    todo = {name: days for name, days in todo.items() if days}
    if not todo:
        return {}
    batch = {
        name: manifest.chosen(read_table(spark, f"{bronze}/{name}", fmt), "ingestion_date", days) for name, days in todo.items()
    }
    rows = platform_rows(batch, as_of)

    def fold(name: str, table: DataFrame) -> None:
        if name == "post_rejected":
            arrival = F.concat_ws(" ", "post_type", "ingestion_date").alias("arrival")
            replace_partitions(table.select("*", arrival), f"{silver}/{name}", "arrival", fmt=fmt)
        else:
            _fold(spark, f"{silver}/{name}", table, name, fmt, layout)

    at_once(spark, [partial(fold, name, table) for name, table in batch_tables(rows).items()], fmt)
    mentioned = _open_mentions(spark, silver, rows, fmt, as_of)
    if mentioned is not None:
        # asked for twice: which names there are, and whose they are
        mentioned, folder = stage(least_per_key(mentioned, KEYS["user_mentions"]), "mentions")
        try:
            asked = mentioned.select(F.col("post_type").alias("user_type"), F.col("mentioned_name").alias("display_name"))
            users = lookup_join(read_table(spark, f"{silver}/user", fmt), asked.distinct(), ["user_type", "display_name"], "left_semi")
            _fold(spark, f"{silver}/user_mentions", _resolved(mentioned, users), "user_mentions", fmt, layout)
        finally:
            files.delete(spark, folder)
    manifest.record(spark, notes, todo)
    return {name: sorted(days) for name, days in todo.items()}
