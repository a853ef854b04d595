"""Upsert laws and edge rows."""

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillwater.operators.keys import dedup_on, latest, resolve
from tillwater.operators.upsert import merge_all, merge_cols, merge_cols_in_place, require_single_match, same_named
from tillwater.plans import retail, sales

PAIR = "k int, v string"


def test_null_keys_are_kept_on_both_sides(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], PAIR)
    source = spark.createDataFrame([(2, "Y"), (3, "z"), (None, "m")], PAIR)
    want = [(1, "x"), (2, "Y"), (3, "z"), (None, "m"), (None, "n")]
    assert rows(merge_all(target, source, ["k"])) == want
    maps = same_named(["k", "v"])
    assert rows(merge_cols(target, source, ["k"], set={"v": "source.v"}, values=maps)) == want


def test_repeated_source_key_is_an_error_only_when_it_matches(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], PAIR)
    with pytest.raises(ValueError, match="several source rows"):
        require_single_match(target, spark.createDataFrame([(2, "a"), (2, "b")], PAIR), ["k"])
    require_single_match(target, spark.createDataFrame([(3, "a"), (3, "b")], PAIR), ["k"])
    require_single_match(target, spark.createDataFrame([(None, "a"), (None, "b")], PAIR), ["k"])


def test_one_source_row_updates_all_target_rows_of_its_key(spark):
    target = spark.createDataFrame([(2, "y"), (2, "w"), (1, "x")], PAIR)
    source = spark.createDataFrame([(2, "Y")], PAIR)
    merged = merge_cols(target, source, ["k"], set={"v": "source.v"}, values=same_named(["k", "v"]))
    assert rows(merged) == [(1, "x"), (2, "Y"), (2, "Y")]


def test_merge_cols_keeps_unset_columns_and_casts(spark):
    target = spark.createDataFrame([(1, 10.0, "keep")], "k int, price double, note string")
    source = spark.createDataFrame([(1, 5), (2, 7)], "k int, price int")
    merged = merge_cols(
        target, source, ["k"],
        set={"price": "target.price + source.price"},
        values={"k": "source.k", "price": "source.price"},
    )
    assert merged.schema == target.schema
    assert rows(merged) == [(1, 15.0, "keep"), (2, 7.0, None)]
    with pytest.raises(ValueError, match="not in the target"):
        merge_cols(target, source, ["k"], set={"nope": "source.k"}, values={})


keyed = st.dictionaries(st.integers(0, 8), st.text("ab", max_size=2), max_size=6)
null_rows = st.lists(st.text("cd", max_size=2), max_size=2)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, null_rows, keyed, null_rows)
def test_upsert_laws(spark, target_map, target_nulls, source_map, source_nulls):
    target_rows = [*target_map.items(), *[(None, v) for v in target_nulls]]
    source_rows = [*source_map.items(), *[(None, v) for v in source_nulls]]
    target = spark.createDataFrame(target_rows, PAIR)
    source = spark.createDataFrame(source_rows, PAIR)
    want = sorted(
        [*{**target_map, **source_map}.items(), *[(None, v) for v in target_nulls + source_nulls]],
        key=lambda r: [(v is None, str(v)) for v in r],
    )
    once = merge_all(target, source, ["k"])
    assert rows(once) == want
    by_columns = merge_cols(target, source, ["k"], set={"v": "source.v"}, values=same_named(["k", "v"]))
    assert rows(by_columns) == want
    keyed_source = source.dropna(subset=["k"])
    again = merge_all(merge_all(target, keyed_source, ["k"]), keyed_source, ["k"])
    assert rows(again) == rows(merge_all(target, keyed_source, ["k"]))


def test_latest_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02", "b"), (1, "2024-01-02", "a"), (1, "2024-01-01", "z"), (2, None, "q")],
        "k int, t string, v string",
    )
    assert rows(latest(df, ["k"], "t")) == [(1, "2024-01-02", "a"), (2, None, "q")]
    with pytest.raises(ValueError, match="required columns"):
        latest(df, ["missing"], "t")


def test_dedup_on_all_columns_is_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b")], PAIR)
    assert rows(dedup_on(df, ["k", "v"])) == [(1, "a"), (None, "b")]


def test_resolve_repeats_no_row(spark):
    df = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "name string")
    dim = spark.createDataFrame([("a", 2), ("a", 1), (None, 9)], "name string, id int")
    assert rows(resolve(df, dim, ["name"], "id")) == [("a", 1), ("a", 1), ("x", None), (None, None)]


BRONZE = "client_id string, name string, ingestion_time timestamp, source_file string"


def test_silver_rows_window_and_helpers(spark):
    bronze = spark.createDataFrame(
        [("1", "old", None, "f"), ("1", "a", None, "f")], BRONZE
    ).selectExpr(
        "client_id", "name",
        "cast(case name when 'old' then '2023-12-01' else '2024-01-05' end as timestamp) ingestion_time",
        "source_file",
    )
    got = retail.silver_rows(bronze, ["client_id"], "2024-01-08")
    assert got.columns == ["client_id", "name"]
    assert rows(got) == [("1", "a")]
    assert retail.silver_rows(bronze, ["client_id"], "2024-03-01").isEmpty()


def _purchases(spark, data):
    return spark.createDataFrame(
        data,
        "product_id string, client_id string, transaction_id string, transaction_datetime string, "
        "regular_points_received double, purchase_sum double, store_id string, product_quantity double",
    ).selectExpr("* except (transaction_datetime)", "cast(transaction_datetime as timestamp) transaction_datetime")


def test_lines_of_one_transaction_are_kept_and_zero_quantity_has_no_price(spark):
    day = "2019-01-02 10:00:00"
    purchases = _purchases(
        spark,
        [
            ("p1", "c", "t1", day, 1.0, 10.0, "s", 2.0),
            ("p2", "c", "t1", day, 1.0, 10.0, "s", 0.0),
            ("p3", "c", "t2", day, 1.0, 10.0, "s", None),
        ],
    )
    facts = sales.increment_facts(purchases)
    prices = {(r.transaction_id, r.product_id): r.unit_price for r in facts.collect()}
    assert prices == {("t1", "p1"): 5.0, ("t1", "p2"): None, ("t2", "p3"): None}
    assert {r.date_key for r in facts.collect()} == {20190102}
    maps = sales.fact_map()
    for once in (False, True):
        assert rows(merge_cols(facts, facts, sales.FACT_KEYS, maps.set, maps.values, once)) == rows(facts)


def test_a_product_without_a_price_keeps_its_line(spark):
    purchases = _purchases(spark, [("gone", "c", "t", "2019-01-02", 1.0, 10.0, "s", 2.9)])
    products = spark.createDataFrame([("p", 3.0)], "product_id string, product_price double")
    row = sales.initial_facts(purchases, products).collect()[0]
    assert (row.product_quantity, row.unit_price, row.purchase_sum, row.payment_method) == (2, None, None, "POS")


@pytest.mark.parametrize("once", [False, True])
def test_both_ways_to_merge_columns_agree(spark, once):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (2, "z", 3), (None, "n", 4)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "Y"), (3, "z"), (None, "m")], "k int, v string")
    merged = merge_cols(target, source, ["k"], {"v": "concat(target.v, source.v)"}, same_named(["k", "v"]), once)
    assert rows(merged) == [(1, "x", 1), (2, "yY", 2), (2, "zY", 3), (3, "z", None), (None, "m", None), (None, "n", 4)]


def test_a_merge_that_reads_once_scans_each_side_once(spark, tmp_path):
    for name in ("target", "source"):
        spark.range(50).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/{name}")
    target, source = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("target", "source"))
    plan = merge_cols(target, source, ["k"], {"v": "source.v"}, same_named(["k", "v"]), once=True)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


@pytest.mark.parametrize("shares", [1, 3])
def test_a_merge_by_place_agrees_and_shuffles_once(spark, shares):
    target = spark.createDataFrame(
        [(1, "x", 1, 7), (2, "y", 2, 7), (2, "z", 3, 7), (None, "n", 4, 8), (5, "e", 5, 8)], "k int, v string, w int, p int"
    )
    source = spark.createDataFrame([(2, "Y", 7), (3, "z", 7), (None, "m", 8), (5, None, 8), (6, "s", 9), (6, "t", 9)], "k int, v string, p int")
    maps = {"v": "concat(target.v, source.v)"}, same_named(["k", "v", "p"])
    merged = merge_cols_in_place(target, source, ["k"], *maps, ["p"], shares)
    assert merged.schema == target.schema
    assert rows(merged) == rows(merge_cols(target, source, ["k"], *maps, once=True))
    merged.collect()
    assert merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
