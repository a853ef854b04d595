"""Plans that must hold when one key has a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from tillwater.operators.aggregates import id_lists
from tillwater.operators.keys import dedup_on, resolve
from tillwater.operators.upsert import merge_all, merge_cols, same_named
from tillwater.plans import platforms, sales, social_entities, social_star
from tillwater.sources.tables import publish, read_table, stage, touched_rows


@pytest.fixture
def eager_splits(spark):
    """Thresholds at which small test tables count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def executed_plan(df):
    """The final adaptive plan, after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows=60_000):
    """Ids with a key that a third of them share; split over several map tasks."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(0, rows, 1, 12).select("id", key.alias("name"), F.sha2(F.col("id").cast("string"), 512).alias("pad"))


def test_resolve_splits_a_hot_key(spark, eager_splits):
    df = skewed(spark)
    joined = resolve(df, df.select("name", F.col("id").alias("found")), ["name"], "found")
    assert "skew=true" in executed_plan(joined)
    assert joined.count() == 60_000
    assert joined.filter("name = 'hot' AND found <> 0").isEmpty()


def test_link_hashtags_splits_a_hot_tag(spark, eager_splits):
    tagged = skewed(spark).select(
        F.lit("A").alias("post_type"), F.concat("id", "pad").alias("post_id"), F.col("name").alias("hashtag_text")
    )
    linked = platforms.link_hashtags(tagged, platforms.hashtag_table(tagged))
    assert "skew=true" in executed_plan(linked)
    assert linked.count() == 60_000


def test_usage_facts_split_a_hot_post(spark, eager_splits):
    df = skewed(spark)
    post = F.lit("A").alias("post_type"), F.col("name").alias("post_id")
    links = df.select(*post, "pad", F.col("id").alias("hashtag_id"))
    posts = df.select(*post, F.lit("2024-01-01").alias("post_date"))
    facts = social_star.hashtag_usage(links, social_star.post_dates(posts, social_star.dim_date(posts)))
    assert "skew=true" in executed_plan(facts)
    assert facts.filter("date_id = 1").count() == 60_000


def test_prices_split_a_hot_product(spark, eager_splits, tmp_path):
    purchases = skewed(spark).selectExpr(
        "name AS product_id", "pad AS client_id", "cast(id AS string) AS transaction_id",
        "date'2019-01-01' AS transaction_datetime", "1.0D AS regular_points_received", "5.0D AS purchase_sum",
        "'s' AS store_id", "2.0D AS product_quantity",
    )
    products = skewed(spark).select(F.col("name").alias("product_id")).distinct()
    products.withColumn("product_price", F.lit(2.0)).write.parquet(f"{tmp_path}/prices")
    facts = sales.initial_facts(purchases, spark.read.parquet(f"{tmp_path}/prices"))
    assert "skew=true" in executed_plan(facts)
    assert facts.count() == 60_000


def test_a_hot_value_is_listed_by_many_tasks(spark, eager_splits):
    lists = id_lists(skewed(spark), "name", "id", chunks=8)
    assert sorted(i for r in lists.filter("name = 'hot'").collect() for i in r.ids) == list(range(0, 60_000, 3))
    # The lists are grouped on (value, chunk), not on the value alone.
    plan = executed_plan(lists)
    assert re.search(r"hashpartitioning\(name#\d+, chunk#\d+", plan)


def test_one_row_per_key_before_the_shuffle(spark):
    plan = executed_plan(dedup_on(skewed(spark), ["name"]))
    final, partial = plan.split("Exchange hashpartitioning")[:2]
    assert "WindowGroupLimit" in final and "WindowGroupLimit" in partial


def test_a_small_batch_leaves_the_target_unshuffled(spark, tmp_path):
    publish(skewed(spark), f"{tmp_path}/target")
    target = read_table(spark, f"{tmp_path}/target")
    batch, _ = stage(spark.range(10).select("id", F.lit("new").alias("name"), F.lit("p").alias("pad")))
    plan = executed_plan(merge_all(target, batch, ["id"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    columns = merge_cols(target, batch, ["id"], set={"name": "source.name"}, values=same_named(target.columns))
    plan = executed_plan(columns)
    # The one shuffle is of the keys found on both sides, after the target was cut down to them.
    assert "SortMergeJoin" not in plan


def test_upsert_of_a_hot_target_key_is_split(spark, eager_splits, tmp_path):
    publish(skewed(spark), f"{tmp_path}/target")
    target = read_table(spark, f"{tmp_path}/target")
    batch, _ = stage(target.groupBy("name").agg(F.max("id").alias("id"), F.max("pad").alias("pad")))
    merged = merge_cols(target, batch, ["name"], set={"id": "source.id"}, values=same_named(["name", "id", "pad"]))
    assert "skew=true" in executed_plan(merged)
    assert merged.count() == 60_000 and merged.filter("name = 'hot'").select("id").distinct().count() == 1


def test_merge_all_splits_a_hot_target_key(spark, eager_splits, tmp_path):
    publish(skewed(spark), f"{tmp_path}/target")
    target = read_table(spark, f"{tmp_path}/target")
    batch, _ = stage(target.filter("name <> 'hot'").groupBy("name").agg(F.max("id").alias("id"), F.max("pad").alias("pad")))
    merged = merge_all(target, batch, ["name"])
    assert "skew=true" in executed_plan(merged)
    assert merged.filter("name = 'hot'").count() == 20_000


def test_mentions_split_a_hot_name(spark, eager_splits):
    rows = skewed(spark).select(
        F.concat(F.lit("u/"), "name").alias("user_posted"),
        F.concat(F.lit("p/"), "id", "pad").alias("post_url"),
        F.concat(F.lit("u/"), "name").alias("tagged_users"),
    )
    found = social_entities.mentions(social_entities.unify({"A": rows}))
    assert "skew=true" in executed_plan(found)
    assert found.filter("mentioned_user_id IS NOT NULL").count() == 60_000


def test_touched_partitions_prune_the_target(spark, tmp_path):
    days = skewed(spark, 300).withColumn("day", (F.col("id") % 10).cast("int"))
    publish(days, f"{tmp_path}/target", partition_by=["day"])
    batch, _ = stage(days.filter("day = 3"))
    rows = touched_rows(read_table(spark, f"{tmp_path}/target"), batch, ["day"])
    assert re.search(r"PartitionFilters: \[[^\]]*\(day#\d+ >?= 3\)", executed_plan(rows))
    assert rows.count() == 30
    several, _ = stage(days.filter("day IN (2, 5)"))
    assert touched_rows(read_table(spark, f"{tmp_path}/target"), several, ["day"]).count() == 60
