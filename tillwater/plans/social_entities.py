"""Users, posts, hashtags, post-hashtag pairs and mentions across platforms.

All platforms go through one plan: their rows are unioned with a platform column
and each entity is derived once.  Ids are hashes of (platform, name), so a post finds
its user's id without a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.functions.hashing import hash_id
from tillwater.functions.text import first_post_id, last_segment, normalize
from tillwater.operators.aggregates import first_date
from tillwater.operators.keys import dedup_on, lookup_join, require_key
from tillwater.operators.shape import align_union, harmonize, typed_nulls
from tillwater.sources import files, manifest
from tillwater.sources.csv import read_by_header
from tillwater.sources.tables import read_table, replace_partitions, stage

# Column names of the platforms and the common name; the first that applies wins
# (fixed values, order matters).
RENAMES = [
    ("user_url", "user_posted"),
    ("post_user", "user_posted"),
    ("commenter_url", "user_posted"),
    ("date_created", "comment_date"),
    ("post_date_created", "comment_date"),
    ("comment", "comment_text"),
    ("comment_user", "user_posted"),
    ("commenter_user_name", "display_name"),
]

# Fixed value: biography text, followed by the platform's name.
BIO_PREFIX = "Người dùng từ "

USED_COLUMNS = [
    "user_posted", "post_url", "post_id", "url", "comment_date",
    "hashtag_comment", "tagged_user_in", "tagged_users",
]


def unify(raw: Mapping[str, DataFrame | Sequence[DataFrame]]) -> DataFrame:
    """The used columns of all platforms, as text, with the platform and its place.

    A platform whose files differ in their columns comes as a frame for each layout; each is
    renamed by itself.  ``has_posts`` tells whether a row's layout can describe posts at all.
    """
    frames = []
    layouts = [
        (place, platform, df)
        for place, (platform, found) in enumerate(raw.items())
        for df in ([found] if isinstance(found, DataFrame) else found)
    ]
    for place, platform, df in layouts:
        rows = harmonize(df, RENAMES)
        present = [c for c in USED_COLUMNS if c in rows.columns]
        absent = {c: "string" for c in USED_COLUMNS if c not in rows.columns}
        frames.append(
            rows.select(
                F.lit(platform).alias("platform"),
                F.lit(place).alias("place"),
                F.lit("post_url" in present and "user_posted" in present).alias("has_posts"),
                *[F.col(c).cast("string").alias(c) for c in present],
                *typed_nulls(absent),
            )
        )
    return align_union(*frames)


def users(rows: DataFrame) -> DataFrame:
    """One user per platform and display name; counters are not known here."""
    named = rows.select("platform", last_segment("user_posted").alias("display_name"))
    names = require_key(named, "display_name").distinct()
    return names.select(
        _user_id(F.col("display_name")).alias("user_id"),
        "display_name",
        F.concat(F.lit(BIO_PREFIX), F.col("platform")).alias("bio"),
        F.lit(True).alias("is_verified"),
        *typed_nulls(
            {"followers_count": "bigint", "following_count": "bigint", "post_count": "bigint"}
        ),
        F.col("platform").alias("type_of_account"),
    )


def _user_id(name: Column) -> Column:
    return hash_id("platform", name)


def _post_rows(rows: DataFrame) -> DataFrame:
    return rows.filter("has_posts").select(
        "platform",
        "comment_date",
        first_post_id("post_id", "url", "post_url").alias("post_id"),
        _user_id(last_segment("user_posted")).alias("user_id"),
        "post_url",
    )


def _has_id() -> Column:
    return F.coalesce(F.trim("post_id") != "", F.lit(False))


def posts(rows: DataFrame, as_of=None) -> DataFrame:
    """One row per platform and post id, dated a day before the platform's first comment."""
    found = _post_rows(rows)
    # One row per platform, and the platforms are listed by the caller.
    dates = first_date(found, "comment_date", as_of, by=["platform"], name="post_date")
    return (
        dedup_on(found.filter(_has_id()).drop("comment_date"), ["platform", "post_id"])
        .join(F.broadcast(dates), "platform")
        .select(
            "platform",
            "post_id",
            "user_id",
            F.lit(None).cast("string").alias("post_content"),
            "post_date",
            "post_url",
        )
    )


def rejected_posts(rows: DataFrame) -> DataFrame:
    """Posts without any id, which cannot be told apart: each row as it is."""
    return _post_rows(rows).filter(~_has_id()).select("platform", "user_id", "post_url", "comment_date")


def hashtags(rows: DataFrame) -> DataFrame:
    texts = rows.select("platform", normalize("hashtag_comment").alias("hashtag_text"))
    return require_key(texts, "hashtag_text").distinct().select(
        "platform", "hashtag_text", hash_id("platform", "hashtag_text").alias("hashtag_id")
    )


def post_hashtags(rows: DataFrame) -> DataFrame:
    return (
        require_key(rows, "post_url", "hashtag_comment")
        .select(
            "platform",
            last_segment("post_url").alias("post_id"),
            hash_id("platform", normalize("hashtag_comment")).alias("hashtag_id"),
        )
        .distinct()
    )


def mentions(rows: DataFrame) -> DataFrame:
    """Distinct (platform, post, mentioned user); the user id is NULL for a name nobody has.

    A name is looked up among the users of the row's platform and of the platforms
    before it; the nearest one wins.  A directory row holds at most one entry per
    platform, so the lookup never repeats a mention.
    """
    named = (
        rows.filter(F.col("post_url").isNotNull())
        .select(
            "place",
            "platform",
            last_segment("post_url").alias("post_id"),
            F.explode(F.array("tagged_user_in", "tagged_users")).alias("mention"),
        )
        .filter(F.col("mention").isNotNull())
        .select("place", "platform", "post_id", last_segment(F.trim("mention")).alias("display_name"))
        .distinct()
    )
    directory = (
        require_key(
            rows.select("place", "platform", last_segment("user_posted").alias("display_name")),
            "display_name",
        )
        .distinct()
        .groupBy("display_name")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("place", _user_id(F.col("display_name")).alias("user_id"))
                )
            ).alias("known")
        )
    )
    reachable = F.filter("known", lambda entry: entry["place"] <= F.col("place"))
    return (
        lookup_join(named, directory, ["display_name"])
        .select("platform", "post_id", F.get(F.reverse(reachable), F.lit(0))["user_id"].alias("mentioned_user_id"))
        .distinct()
    )


def entities(rows: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """The tables of the unified rows, each with its rows' platform."""
    return {
        "dim_users": users(rows).withColumn("platform", F.col("type_of_account")),
        "dim_posts": posts(rows, as_of),
        "post_rejected": rejected_posts(rows),
        "dim_hashtags": hashtags(rows),
        "fact_post_hashtags": post_hashtags(rows),
        "fact_user_mentions": mentions(rows),
    }


def load_entities(
    spark: SparkSession, source: Mapping[str, str] | str, bronze_path: str, fmt: str = "parquet", as_of=None
) -> None:
    """CSV files by platform, or a folder of them: read as strings, write the entities to bronze.

    Files are aligned by the names in their headers, whatever the columns' order.  The CSV text is
    parsed once, into the few columns that the tables share.  Bronze is partitioned by platform, and
    the platforms that this load has replace their partitions; the others stay.
    """
    paths = platform_files(spark, source) if isinstance(source, str) else source
    raw = {name: read_by_header(spark, found) for name, found in paths.items()}
    if not any(raw.values()):
        return
    unified, staged = stage(unify(raw), "unified")
    try:
        for table, rows in entities(unified, as_of).items():
            stamped = rows.withColumn("ingestion_time", F.current_timestamp())
            replace_partitions(stamped, f"{bronze_path.rstrip('/')}/{table}", "platform", list(raw), fmt)
    finally:
        files.delete(spark, staged)


def platform_files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Platform name -> its CSV files in a folder; the name is the text before a file's first dash, or all of it."""
    found: dict[str, list[str]] = {}
    for name in files.names(spark, folder):
        if name.lower().endswith(".csv"):
            found.setdefault(name.partition("-")[0], []).append(f"{folder.rstrip('/')}/{files.as_pattern(name)}")
    return dict(sorted(found.items()))


def clean_posts(posts: DataFrame, days_back: int = 0) -> DataFrame:
    """post_date as a date.  The entity step has moved it back already, hence 0 days."""
    return posts.withColumn("post_date", F.date_sub(F.col("post_date").try_cast("date"), days_back))


def clean_hashtags(hashtags: DataFrame) -> DataFrame:
    return hashtags.withColumn("hashtag_text", F.lower("hashtag_text"))


CLEANERS = {"dim_posts": clean_posts, "dim_hashtags": clean_hashtags}
TABLES = ("dim_users", "dim_posts", "post_rejected", "dim_hashtags", "fact_post_hashtags", "fact_user_mentions")


def refresh_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, fmt: str = "parquet", cleaners=CLEANERS
) -> dict[str, list[str]]:
    """Clean the platforms of bronze that changed since the last run, and replace their partitions of silver.

    What earlier runs have cleaned is neither read nor written; a manifest beside the silver tables
    says what that is.  Returns the platforms by table.
    """
    bronze, silver = bronze_path.rstrip("/"), silver_path.rstrip("/")
    notes, done = f"{silver}/manifest", {}
    for table in TABLES:
        todo = manifest.pending(spark, notes, table, f"{bronze}/{table}", "platform")
        if not todo:
            continue
        rows = manifest.chosen(read_table(spark, f"{bronze}/{table}", fmt), "platform", todo)
        clean = cleaners.get(table, lambda df: df)
        replace_partitions(clean(rows), f"{silver}/{table}", "platform", [] if manifest.WHOLE in todo else list(todo), fmt)
        done[table] = todo
    if done:
        manifest.record(spark, notes, done)
    return {table: sorted(todo) for table, todo in done.items()}
