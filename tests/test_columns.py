"""Column expressions on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from tillwater.functions import text
from tillwater.functions.dates import date_key
from tillwater.functions.hashing import digits_id, draws, hash_id, hash_number, pick, pick_int
from tillwater.functions.regions import region_of
from tillwater.functions.repair import (
    parsed_int, repair_id, repair_int, repair_name, repair_text, repair_ts, repair_url,
)
from tillwater.sources.schemas import layout


def values(spark, inputs, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[1] for r in df.select("i", column).orderBy("i").collect()]


def test_numbers_that_do_not_parse(spark):
    texts = ["abc", "1.5", "1e3", "99999999999", "", " 12 ", None, "+7", "-8", "000000000000000000012",
             "2147483647", "2147483648", "7123456789012345678", "99999999999999999999999"]
    want = [None, None, None, None, None, 12, None, 7, -8, 12, 2147483647, None, None, None]
    assert values(spark, texts, parsed_int("c")) == want
    assert values(spark, ["x", "5"], repair_int("c", F.lit(20))) == [20, 5]


def test_other_repairs(spark):
    assert values(spark, ["123456789012", "12", None, "1234567890123"], repair_id("c", F.lit(7))) == [
        123456789012, 7, 7, 7,
    ]
    assert values(spark, ["unknown", "", '"x', "ann", None], repair_name("c", F.lit("N"), ["unknown", ""], ['"'])) == [
        "N", "N", "N", "ann", None,
    ]
    assert values(spark, [None, "a"], repair_text("c")) == ["unknown", "a"]
    assert values(spark, [None, "u"], repair_url("c", "https://x/", F.lit(5))) == ["https://x/5", "u"]
    stamps = values(spark, ["2024-01-02 03:04:05", "junk", None], repair_ts("c", "2024-02-11", 10))
    assert [str(s) for s in stamps] == ["2024-01-02 03:04:05", "2024-02-01 00:00:00", "2024-02-01 00:00:00"]


def test_url_segments(spark):
    urls = ["https://a/b/c/", "abc", "", None, "/", "https://a/b//"]
    assert values(spark, urls, text.last_segment("c")) == ["c", "abc", None, None, None, "b"]


def test_first_post_id(spark):
    df = spark.createDataFrame(
        [("7", "u/1", "p/2"), ("", "u/1/", "p/2"), (None, "", "p/2/"), (None, None, None)],
        "post_id string, url string, post_url string",
    )
    got = [r[0] for r in df.select(text.first_post_id("post_id", "url", "post_url")).collect()]
    assert got == ["7", "1", "2", None]


def test_handles(spark):
    tiktok = ["https://www.tiktok.com/@ann?x=1", "https://other.example/x", "", None]
    got = values(spark, tiktok, text.tiktok_handle("c", "c"))
    assert got[0] == "ann" and got[1] in text.FALLBACK_NAMES and got[2:] == [None, None]
    instagram = ["https://www.instagram.com/ann/", "plain", None]
    got = values(spark, instagram, text.instagram_handle("c", "i"))
    assert got[0] == "ann" and set(got[1:]) <= set(text.FALLBACK_NAMES)
    assert values(spark, ["Ann Lee"], text.twitter_profile("c")) == ["http://x.com/annlee"]
    assert values(spark, [" ", None], text.twitter_name("c", "i"))[0] in text.FALLBACK_NAMES


def test_tag_lists(spark):
    lists = ['["a","b","a"]', "null", "unknown", None, "", '["null_hehe"_hehe", "x"]', '[]', "[NULL, c]"]
    assert values(spark, lists, text.tags("c")) == [["a", "b"], [], [], [], [], ["x"], [], ["c"]]
    assert values(spark, ['a, "b",a'], text.tags("c", bracketed=False)) == [["a", "b"]]


def test_tag_pairs(spark):
    lists = ['["k:v"; "x:null"]', "text", None, "a:b:c, d : e", "[:v,k:]"]
    got = [[tuple(p) for p in row] for row in values(spark, lists, text.tag_pairs("c"))]
    assert got == [[("k", "v")], [], [], [("a", "b:c"), ("d", "e")], []]


def test_levels(spark):
    arrays = [[7, 8], [], None]
    levels = [values(spark, arrays, text.level("c", n), "array<int>") for n in (1, 2, 3, 4)]
    assert levels == [["7", None, None], ["8", None, None], [None] * 3, [None] * 3]


def test_composite_and_market_ids(spark):
    assert values(spark, ["a", None], text.composite_id("c", "i")) == ["a_0", None]
    ids = ["v1|286456111122|0", "v1|12|3|0", "v1|x|0", "short", "", None]
    assert values(spark, ids, text.market_id("c")) == [286456111122, 12, None, None, None, None]


def test_regions(spark):
    places = ["Hoan Kiem, Hà Nội", "Đà Nẵng", "Quận 1, TP Hồ Chí Minh", "Nowhere", None, "x,  CẦN   THƠ ",
              "Hà Nội"]
    assert values(spark, places, region_of("c")) == [
        "red_river_delta", "south_central", "southeast", "unknown", None, "southwest", "red_river_delta",
    ]


def test_picks_are_stable_and_in_range(spark):
    df = spark.range(2000).withColumn("n", hash_number("id"))
    made = draws("n", {"a": (1, 20), "b": (0, 100), "c": (10**9, 10**10 - 1)})
    got = df.select(
        *[column.alias(name) for name, column in made.items()],
        pick(["x", "y"], "id").alias("p"), pick_int(5, 6, "id").alias("q"), digits_id(12, "id").alias("d"),
    )
    first, again = got.collect(), got.collect()
    assert first == again
    assert {r.a for r in first} == set(range(1, 21)) and {r.p for r in first} == {"x", "y"}
    assert {r.q for r in first} == {5, 6} and all(0 <= r.b <= 100 for r in first)
    assert all(len(str(r.d)) == 12 and len(str(r.c)) == 10 for r in first)
    with pytest.raises(ValueError):
        draws("n", {"a": (0, 10**12), "b": (0, 10**12)})


def test_hash_id_is_null_for_a_null_key(spark):
    assert values(spark, ["a", None], hash_id(F.lit("p"), "c").isNull()) == [False, True]


def test_date_key(spark):
    assert values(spark, ["2018-11-22", None], date_key(F.col("c").cast("date"))) == [20181122, None]


def test_layout_types():
    assert layout("a string, b array<int>").simpleString() == "struct<a:string,b:array<int>>"
