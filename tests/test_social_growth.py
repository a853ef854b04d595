"""What the social steps do per row: few repeats, sorts led by numbers, nothing derived twice."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tillwater.operators.keys import dedup_on, least_per_key
from tillwater.operators.upsert import merge_all
from tillwater.plans import platforms, social_star
from tillwater.sources.tables import at_once, publish, read_table, stage


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_users_of_a_batch_are_projected_once_each(spark):
    comments = spark.range(600).select(
        F.concat(F.lit("u"), (F.col("id") % 3).cast("string")).alias("user_id"), F.lit("Ann").alias("user_name"),
        F.lit(None).cast("string").alias("user_url"), F.col("id").cast("string").alias("post_id"), F.lit("p/1").alias("post_url"),
    )
    found = platforms.facebook(comments, "2024-02-01")
    assert found.posts.count() == 600
    assert sorted(r.user_id for r in found.users.collect()) == ["u0", "u1", "u2"]


def test_dedup_sorts_by_a_number_first(spark):
    keyed = spark.createDataFrame([("a", None, 2), ("a", None, 1), (None, "a", 3), (None, "a", 3)], "k string, l string, v int")
    found = dedup_on(keyed, ["k", "l"])
    assert rows(found) == [("a", None, 1), (None, "a", 3)] and found.columns == ["k", "l", "v"]
    assert "xxhash64(k" in plan_of(found)


def test_a_days_load_is_written_from_the_tasks_it_is_in(spark, tmp_path):
    day = spark.range(0, 90, 1, 3).withColumn("day", F.lit("2024-02-01").cast("date"))
    for times in (1, 2):
        publish(day, f"{tmp_path}/t", "append", partition_by=["day"], gathered=False)
        assert len([n for n in os.listdir(f"{tmp_path}/t/day=2024-02-01") if n.startswith("part-")]) == 3 * times
    assert read_table(spark, f"{tmp_path}/t").count() == 180


def test_steps_on_different_tables_run_side_by_side(spark):
    meeting, ended = threading.Barrier(2), []

    def meet():
        meeting.wait(60)
        ended.append(spark.range(3).count())

    at_once(spark, [meet, meet])
    assert ended == [3, 3]

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        at_once(spark, [fail, lambda: ended.append(spark.range(4).count())])
    assert ended == [3, 3, 4]
    busy = threading.Lock()

    def alone():
        assert busy.acquire(blocking=False)
        threading.Event().wait(0.05)
        busy.release()

    at_once(spark, [alone] * 3, "delta")


def test_one_column_beside_the_key_is_grouped_without_a_sort(spark):
    seen = spark.createDataFrame([("p", "a", "2024-02-02"), ("p", "a", "2024-02-01"), ("p", "b", None), (None, "b", None), ("p", "a", None)],
                                 "post_id string, name string, day string").withColumn("day", F.to_date("day"))
    found = least_per_key(seen, ["post_id", "name"])
    assert [(r[0], r[1], str(r[2])) for r in rows(found)] == [("p", "a", "2024-02-01"), ("p", "b", "None"), (None, "b", "None")]
    assert "SortAggregate" not in plan_of(found)


def test_mentions_of_a_batch_are_derived_once(spark, tmp_path, monkeypatch):
    staged = []

    def noted(df, purpose="batch"):
        found = stage(df, purpose)
        staged.append((purpose, found[0].count()))
        return found

    monkeypatch.setattr(platforms, "stage", noted)
    tweets = spark.range(40).select(
        (F.col("id") % 2).cast("string").alias("id"), F.lit("Ann").alias("user_posted"), F.lit("x").alias("description"),
        F.lit("u").alias("url"), F.lit("Ann").alias("tagged_users"), F.lit(None).cast("string").alias("hashtags"),
        F.lit("2024-02-01").cast("date").alias("ingestion_date"),
    )
    publish(tweets, f"{tmp_path}/bronze/twitter", partition_by=["ingestion_date"])
    platforms.refresh_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", as_of="2024-02-01")
    assert staged == [("mentions", 2)]
    named = read_table(spark, f"{tmp_path}/silver/user_mentions").collect()
    assert sorted(r.post_id for r in named) == ["0", "1"] and all(r.mentioned_user_id for r in named)


def test_links_of_posts_that_came_are_taken_once(spark):
    links = spark.createDataFrame(
        [("A", "1", "t", "2024-01-01"), ("A", "1", "u", "2024-01-01"), ("A", "1", "v", "2024-02-08"), ("A", "2", "t", "2024-01-01"),
         ("A", "2", "w", "2024-02-09"), ("A", "3", "t", None), ("A", "4", "t", None), ("A", "1", "t", "2024-02-08")],
        "post_type string, post_id string, hashtag_id string, ingestion_date string",
    ).withColumn("ingestion_date", F.to_date("ingestion_date"))
    posts = spark.createDataFrame([("A", "1"), ("A", "1"), ("A", "3")], "post_type string, post_id string")
    found = social_star._of_posts(links, posts, "2024-02-08", ["post_type", "post_id", "hashtag_id"])
    assert rows(found) == [("A", "1", "t"), ("A", "1", "u"), ("A", "1", "v"), ("A", "2", "w"), ("A", "3", "t")]
    assert "SortAggregate" not in plan_of(found)


def test_merge_matches_keys_by_hash_and_by_value(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    merged = merge_all(target, spark.createDataFrame([("b", 2), (None, 2)], "k string, v int"), ["k"])
    assert rows(merged) == [("a", 1), ("b", 2), (None, 1), (None, 2)] and "xxhash64(k" in plan_of(merged)
    wide = spark.createDataFrame([(1, 1), (2, 1)], "k bigint, v int")
    assert rows(merge_all(wide, spark.createDataFrame([(2, 2)], "k int, v int"), ["k"])) == [(1, 1), (2, 2)]
