"""URL segments, handles, tag lists and ids held in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwater.functions.hashing import pick

# Display names given to users who have none.
FALLBACK_NAMES = [
    "Darth Vader", "Luke Skywalker", "Leia Organa", "Han Solo", "Yoda",
    "Obi-Wan Kenobi", "Chewbacca", "R2-D2", "C-3PO", "Padmé Amidala",
    "Anakin Skywalker", "Boba Fett", "Darth Maul", "Kylo Ren", "Rey", "Finn",
    "Poe Dameron", "BB-8", "Jyn Erso", "Cassian Andor", "Saw Gerrera",
    "Mon Mothma", "Ahsoka Tano", "Ezra Bridger", "Kanan Jarrus", "Sabine Wren",
]

# Texts that mean "no tag".
NO_TAG = "unknown"
NULL_TAG = "null"
PLACEHOLDER_TAG = 'null_hehe"_hehe'

# Fixed value: how a TikTok profile URL names its owner.
TIKTOK_HANDLE = r"tiktok\.com/@([^/?]+)"

TWITTER_PROFILE = "http://x.com/"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _not_empty(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def _unquoted(column: Column) -> Column:
    return F.trim(F.trim(column), F.lit('"'))


def normalize(column: Column | str) -> Column:
    return F.trim(F.lower(_col(column)))


def last_segment(url: Column | str) -> Column:
    """Text after the last inner slash; trailing slashes do not count."""
    path = F.rtrim(_col(url), F.lit("/"))
    return _not_empty(F.substring_index(path, "/", -1))


def first_post_id(post_id: Column | str, url: Column | str, post_url: Column | str) -> Column:
    """The id column if filled, else the last segment of url, else of post_url."""
    return F.coalesce(_not_empty(_col(post_id)), last_segment(url), last_segment(post_url))


def instagram_handle(url: Column | str, *keys: Column | str) -> Column:
    """Second-last part of a profile URL, or a name picked by ``keys``."""
    parts = F.split(F.trim(_col(url)), "/")
    return F.when(F.size(parts) >= 2, F.get(parts, F.size(parts) - 2)).otherwise(
        pick(FALLBACK_NAMES, *keys)
    )


def tiktok_handle(url: Column | str, *keys: Column | str) -> Column:
    """Name after ``tiktok.com/@``; a picked name for other URLs; NULL without a URL."""
    column = _col(url)
    found = _not_empty(F.regexp_extract(column, TIKTOK_HANDLE, 1))
    return F.when(
        column.isNotNull() & (column != ""), F.coalesce(found, pick(FALLBACK_NAMES, *keys))
    )


def twitter_name(name: Column | str, *keys: Column | str) -> Column:
    column = _col(name)
    return F.when(F.trim(F.coalesce(column, F.lit(""))) == "", pick(FALLBACK_NAMES, *keys)).otherwise(
        column
    )


def twitter_profile(name: Column | str) -> Column:
    return F.concat(F.lit(TWITTER_PROFILE), F.lower(F.replace(_col(name), F.lit(" "), F.lit(""))))


def tags(column: Column | str, bracketed: bool = True) -> Column:
    """Distinct tags of a comma-separated list; an empty array where there is none."""
    text = F.trim(_col(column))
    absent = text.isNull() | (text == "") | (text == NO_TAG) | (F.lower(text) == NULL_TAG)
    body = F.substring(text, F.lit(2), F.length(text) - 2) if bracketed else text
    found = F.filter(
        F.transform(F.split(body, ","), _unquoted),
        lambda tag: ~tag.isin("", NO_TAG, PLACEHOLDER_TAG) & (F.trim(F.lower(tag)) != NULL_TAG),
    )
    return F.when(absent, F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def tag_pairs(column: Column | str) -> Column:
    """``[a:b; c:d]`` as an array of (key, value); commas separate where no ``;`` occurs."""
    text = F.trim(F.trim(_col(column)), F.lit("[]"))
    parts = F.when(F.contains(text, F.lit(";")), F.split(text, ";")).otherwise(F.split(text, ","))
    with_colon = F.filter(F.transform(parts, _unquoted), lambda part: F.instr(part, ":") > 0)
    pairs = F.transform(
        with_colon,
        lambda part: F.struct(
            F.trim(F.substring_index(part, ":", 1)).alias("key"),
            F.trim(F.substring(part, F.instr(part, ":") + 1, F.length(part))).alias("value"),
        ),
    )
    kept = F.filter(
        pairs,
        lambda pair: (pair["key"] != "")
        & ~pair["value"].isin("", PLACEHOLDER_TAG)
        & (F.lower(pair["value"]) != NULL_TAG),
    )
    return F.coalesce(kept, F.array().cast("array<struct<key:string,value:string>>"))


def composite_id(left: Column | str, right: Column | str) -> Column:
    """``left_right``; NULL when either side is NULL."""
    return F.concat(_col(left).cast("string"), F.lit("_"), _col(right).cast("string"))


def level(categories: Column | str, number: int) -> Column:
    """Entry ``number`` (from 1) of an array as text; NULL when the array is short."""
    return F.get(_col(categories), F.lit(number - 1)).cast("string")


def market_id(column: Column | str) -> Column:
    """``v1|123|0``: drop 3 leading and 2 trailing characters, keep the text before ``|``."""
    text = _col(column)
    inner = F.when(
        F.length(text) > 5, F.substring(text, F.lit(4), F.length(text) - 5)
    )
    return F.substring_index(inner, "|", 1).try_cast("bigint")
