"""Repair the raw rows of each platform's CSV and append them to bronze.

Replacement values come from one hash of the whole raw row, so they differ between rows
and are the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tillwater.functions.hashing import draws, option_at, row_id, row_numbers
from tillwater.functions.repair import (
    repair_id, repair_int, repair_name, repair_number_id, repair_text, repair_text_id, repair_ts, repair_url,
)
from tillwater.functions.text import FALLBACK_NAMES
from tillwater.sources.csv import read_csv, with_provenance
from tillwater.sources.schemas import INSTAGRAM_COMMENTS, TIKTOK_COMMENTS, TWITTER_POSTS
from tillwater.sources.tables import publish

# Defaults and rejected texts.
UNKNOWN = "unknown"
TWITTER_URL = "https://x.com/starwars/"
TIKTOK_VIDEO = "https://tiktok.com/@username/video/"
TIKTOK_USER = "https://tiktok.com/@username"
NAME_PREFIXES = ["https", '"', "m"]
TWITTER_COUNTERS = [
    "photos", "videos", "followers", "following", "posts_count",
    "replies", "reposts", "likes", "views",
]
TWITTER_DAYS, TIKTOK_DAYS = 10, 1

# Ranges of the replacement values.
SMALL = (1, 20)
PERCENT = (0, 100)
TWELVE_DIGITS = (10**11, 10**12 - 1)
NAME_PLACE = (0, len(FALLBACK_NAMES) - 1)

FIRST, SECOND = "_first", "_second"
PROVENANCE = ("ingestion_time", "source_file")


def _source_columns(df: DataFrame) -> list[str]:
    """The columns of the file; when and from where a row came does not change its repair."""
    return [c for c in df.columns if c not in PROVENANCE]


def _with_row_numbers(df: DataFrame) -> DataFrame:
    first, second = row_numbers(*_source_columns(df))
    return df.withColumns({FIRST: first, SECOND: second})


def _int_columns(df: DataFrame) -> set[str]:
    """Columns the CSV schema has read as ints: a bad text is NULL there already."""
    return {f.name for f in df.schema.fields if isinstance(f.dataType, IntegerType)}


def repair_instagram(df: DataFrame) -> DataFrame:
    made = draws(FIRST, {"likes_number": PERCENT, "replies_number": PERCENT, "comment_id": TWELVE_DIGITS})
    made |= draws(SECOND, {"post_id": TWELVE_DIGITS})
    ints = _int_columns(df)
    repaired = _with_row_numbers(df).withColumns(
        {
            **{c: repair_int(c, made[c], c in ints) for c in ("likes_number", "replies_number")},
            **{c: repair_id(c, made[c]) for c in ("comment_id", "post_id")},
        }
    )
    return repaired.drop(FIRST, SECOND).fillna(UNKNOWN)


def repair_twitter(df: DataFrame, as_of=None) -> DataFrame:
    made = draws(
        FIRST,
        {"user_posted": NAME_PLACE, "name": NAME_PLACE, **{c: SMALL for c in TWITTER_COUNTERS}},
    )
    a_name = {c: option_at(FALLBACK_NAMES, made[c]) for c in ("user_posted", "name")}
    ints = _int_columns(df)
    repaired = _with_row_numbers(df).withColumns(
        {
            "id": repair_number_id("id", row_id("post", *_source_columns(df))),
            "user_posted": repair_name("user_posted", a_name["user_posted"], [UNKNOWN, ""], ['"']),
            "name": repair_name("name", a_name["name"], [UNKNOWN], NAME_PREFIXES),
            "date_posted": repair_ts("date_posted", as_of, TWITTER_DAYS),
            "tagged_users": repair_text("tagged_users", UNKNOWN),
            **{c: repair_int(c, made[c], c in ints) for c in TWITTER_COUNTERS},
        }
    )
    return repaired.withColumn("url", repair_url("url", TWITTER_URL, "id")).drop(FIRST, SECOND)


def repair_tiktok(df: DataFrame, as_of=None) -> DataFrame:
    numbers = ("num_likes", "num_replies")
    made = draws(FIRST, {c: SMALL for c in numbers})
    repaired = _with_row_numbers(df).withColumns(
        {
            **{c: repair_int(c, made[c]) for c in numbers},
            "comment_id": repair_text_id("comment_id", row_id("comment", *_source_columns(df))),
            "post_id": repair_text_id("post_id", row_id("post", *_source_columns(df))),
            **{
                c: repair_ts(c, as_of, TIKTOK_DAYS) for c in ("post_date_created", "date_created")
            },
            **{
                c: repair_text(c, UNKNOWN)
                for c in ("comment_text", "commenter_user_name", "commenter_id")
            },
            "commenter_url": repair_url("commenter_url", TIKTOK_USER),
        }
    )
    # The repaired comment_id goes into the default URLs.
    return repaired.withColumns(
        {c: repair_url(c, TIKTOK_VIDEO, "comment_id") for c in ("url", "post_url", "comment_url")}
    ).drop(FIRST, SECOND)


def load_platforms(
    spark: SparkSession, folder: str, bronze_path: str, fmt: str = "parquet", as_of=None, by_day: bool = True
) -> None:
    """Read the four platforms' CSV files, repair three of them, append each to bronze.

    ``by_day`` adds an ingestion_date partition, by which the next layer reads new days only.

    Every row says when it was ingested and from which file, so that a second run of a file
    can be told from new data and silver can date a post by its arrival.
    """
    base, bronze = folder.rstrip("/"), bronze_path.rstrip("/")

    def rows(file: str, schema=None) -> DataFrame:
        return with_provenance(read_csv(spark, f"{base}/{file}", schema=schema), as_of)

    instagram = rows("Instagram-datasets.csv", INSTAGRAM_COMMENTS)
    twitter = rows("Twitter-datasets.csv", TWITTER_POSTS)
    tiktok = rows("TikTok-datasets.csv", TIKTOK_COMMENTS)
    tables = {
        "facebook": rows("facebook_datasets.csv"),
        "instagram": repair_instagram(instagram),
        "twitter": repair_twitter(twitter, as_of),
        "tiktok": repair_tiktok(tiktok, as_of),
    }
    for name, repaired in tables.items():
        if by_day:
            repaired = repaired.withColumn("ingestion_date", F.to_date("ingestion_time"))
        publish(repaired, f"{bronze}/{name}", "append", fmt, partition_by=("ingestion_date",) if by_day else ())
