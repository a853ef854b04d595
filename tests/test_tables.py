"""Tables on disk: publish, swap recovery, append, upsert, CSV, calendar."""

import glob
import os
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwater.operators.aggregates import first_date, id_lists, last_writer
from tillwater.operators.shape import align_union, conform, harmonize
from tillwater.plans import calendar, loads, marketplace, platforms, retail, sales, social_entities, social_repair, social_star
from tillwater.sources import files, manifest
from tillwater.sources.csv import export_csv, read_csv
from tillwater.sources.schemas import CLIENTS, SILVER_USER, layout
from tillwater.operators.upsert import merge_statement
from tillwater.sources.tables import ColumnMap, laid_out, landed, mend, publish, read_table, replace_partitions, table_exists, upsert_table

PAIR = "k int, v string"


def frame(spark, data, schema=PAIR):
    return spark.createDataFrame(data, schema)


def test_overwrite_may_read_the_table_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(frame(spark, [(1, "a"), (2, "b")]), path)
    publish(read_table(spark, path).filter("k = 1"), path)
    assert rows(read_table(spark, path)) == [(1, "a")]
    assert os.listdir(tmp_path) == ["t"]


def test_overwrite_checks_the_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(frame(spark, [(1, "a")]), path)
    other = frame(spark, [(1, 2)], "k int, n int")
    with pytest.raises(ValueError, match="replace_schema"):
        publish(other, path)
    publish(other, path, replace_schema=True)
    assert read_table(spark, path).columns == ["k", "n"]
    with pytest.raises(ValueError, match="mode"):
        publish(other, path, "replace")


def test_append_aligns_and_checks(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(frame(spark, [(1, "a")]), path)
    publish(frame(spark, [(2,)], "k int"), path, "append")
    assert rows(read_table(spark, path)) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError, match="not in the table"):
        publish(frame(spark, [(1, 2)], "k int, n int"), path, "append")
    with pytest.raises(ValueError, match="types differ"):
        publish(frame(spark, [("x",)], "k string"), path, "append")


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(frame(spark, [(1, "a")]), path)
    with pytest.raises(Exception):
        publish(frame(spark, [(1, "a")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string")), path)
    assert rows(read_table(spark, path)) == [(1, "a")]


def test_a_swap_cut_short_is_mended_only_when_asked(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(frame(spark, [(1, "a")]), path)
    files.move(spark, path, f"{path}.previous")
    for step in (lambda: table_exists(spark, path), lambda: publish(frame(spark, [(2, "b")]), path)):
        with pytest.raises(RuntimeError, match="cut short"):
            step()
    assert mend(spark, path) and not mend(spark, path)
    assert rows(read_table(spark, path)) == [(1, "a")]
    assert not table_exists(spark, f"{tmp_path}/none")


def test_a_move_onto_a_present_folder_is_refused(spark, tmp_path):
    one, other = f"{tmp_path}/one", f"{tmp_path}/other"
    publish(frame(spark, [(1, "a")]), one)
    publish(frame(spark, [(2, "b")]), other)
    with pytest.raises(FileExistsError):
        files.move(spark, other, one)
    assert rows(read_table(spark, one)) == [(1, "a")] and rows(read_table(spark, other)) == [(2, "b")]


def test_merge_statement():
    assert merge_statement("delta.`/t`", "batch", ["a", "b"]) == (
        "MERGE INTO delta.`/t` AS target USING batch AS source ON target.a = source.a AND target.b = source.b "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    mapped = merge_statement("t", "s", ["k"], {"p": "target.p + source.p"}, {"k": "source.k", "p": "source.p"})
    assert mapped.endswith(
        "WHEN MATCHED THEN UPDATE SET target.p = target.p + source.p "
        "WHEN NOT MATCHED THEN INSERT (k, p) VALUES (source.k, source.p)"
    )


def test_a_bucketed_table_rewrites_touched_buckets_only(spark, tmp_path):
    path, layout = f"{tmp_path}/t", ["bucket_of_8"]
    upsert_table(spark, path, frame(spark, [(k, "a") for k in range(40)] + [(None, "n")]), ["k"], partition_by=layout)
    before, batch = _dirs(path), frame(spark, [(3, "A"), (99, "b"), (None, "m")])
    assert read_table(spark, path).columns == ["k", "v"] and len(before) == 8
    upsert_table(spark, path, batch, ["k"], columns=ColumnMap({"v": "source.v"}, {"k": "source.k", "v": "source.v"}))
    after = _dirs(path)
    touched = {f"bucket_of_8={r[0]}" for r in laid_out(batch, layout, ["k"]).select(layout[0]).collect()}
    assert {d for d in after if after[d] != before[d]} == touched and len(touched) < 8
    want = [(k, "A" if k == 3 else "a") for k in range(40)] + [(99, "b"), (None, "n"), (None, "m")]
    assert rows(read_table(spark, path)) == rows(frame(spark, want))
    wider = frame(spark, [(3, "w")], "k bigint, v string").withColumn("k", F.col("k").cast("int"))
    for _ in range(2):
        upsert_table(spark, path, wider, ["k"], partition_by=["bucket_of_64"])  # the table's own layout holds
        assert rows(read_table(spark, path).filter("k = 3")) == [(3, "w")] and len(_dirs(path)) == 8


def test_an_empty_partitioned_table_keeps_its_columns(spark, tmp_path):
    path, none = f"{tmp_path}/t", frame(spark, [])
    upsert_table(spark, path, none, ["k"], partition_by=["bucket_of_8"])
    assert read_table(spark, path).dtypes == [("k", "int"), ("v", "string")] and read_table(spark, path).count() == 0
    for _ in range(2):
        upsert_table(spark, path, frame(spark, [(1, "a"), (2, "b")]), ["k"], partition_by=["bucket_of_8"])
        assert rows(read_table(spark, path)) == [(1, "a"), (2, "b")]
    replace_partitions(none.withColumn("day", F.lit("x")), f"{tmp_path}/days", "day")
    replace_partitions(frame(spark, [(1, "a")]).withColumn("day", F.lit("x")), f"{tmp_path}/days", "day")
    assert rows(read_table(spark, f"{tmp_path}/days")) == [(1, "a", "x")]
    replace_partitions(none.withColumn("day", F.lit("x")), f"{tmp_path}/days", "day", ["x"])
    assert read_table(spark, f"{tmp_path}/days").count() == 0


def test_a_quotient_layout_rewrites_touched_months_only(spark, tmp_path):
    path, schema, layout = f"{tmp_path}/t", "k int, day int", ["div_100_of_day"]
    upsert_table(spark, path, frame(spark, [(1, 20240105), (2, 20240228), (3, 20240301)], schema), ["k"], partition_by=layout)
    before = _dirs(path)
    assert set(before) == {f"div_100_of_day={m}" for m in (202401, 202402, 202403)}
    upsert_table(spark, path, frame(spark, [(2, 20240229), (4, 20240201)], schema), ["k"], partitions_move=False)
    after = _dirs(path)
    assert {d for d in after if after[d] != before[d]} == {"div_100_of_day=202402"}
    upsert_table(spark, path, frame(spark, [(1, 20240331)], schema), ["k"])  # moves, so the table is rewritten
    assert rows(read_table(spark, path)) == [(1, 20240331), (2, 20240229), (3, 20240301), (4, 20240201)]


def test_transactional_tables_are_merged_by_the_callers_maps(spark, tmp_path, monkeypatch):
    """The statements for a format whose jar is not here; its table is stood in for by files."""
    from tillwater.sources import tables

    said = []
    monkeypatch.setattr(tables, "_merge_in_place", lambda spark, source, statement: said.append((source.columns, statement)))
    monkeypatch.setattr(tables, "read_table", lambda spark, path, *rest: spark.read.parquet(path))
    monkeypatch.setattr(retail, "read_table", tables.read_table)
    monkeypatch.setattr(sales, "read_table", tables.read_table)
    purchases = frame(
        spark, [("p", "c", "t", "2019-01-02", 1.0, 10.0, "s", 2.0, "2024-01-08")],
        "product_id string, client_id string, transaction_id string, transaction_datetime string, "
        "regular_points_received double, purchase_sum double, store_id string, product_quantity double, ingestion_date string",
    )
    stores = frame(spark, [("1", "a", "b", "c", "d", "e"), (None, "a", "b", "c", "d", "e")],
                   "store_id string, store_name string, store_location string, region string, store_format string, "
                   "first_issue_date string")
    for name, rows_ in (("stores", stores), ("purchases", purchases)):
        rows_.write.parquet(f"{tmp_path}/{name}")
    stores.write.parquet(f"{tmp_path}/gold")
    sales.increment_facts(purchases).write.parquet(f"{tmp_path}/facts")
    retail.refresh_gold(spark, "stores", f"{tmp_path}/stores", f"{tmp_path}/gold", "delta")
    sales.refresh_facts(spark, f"{tmp_path}/purchases", f"{tmp_path}/facts", "delta", since="2024-01-08")
    (gold_columns, gold), (fact_columns, facts) = said
    assert gold_columns == retail.GOLD_COLUMNS["stores"] and fact_columns == sales.INCREMENT_COLUMNS
    assert gold.startswith(f"MERGE INTO delta.`{tmp_path}/gold` AS target USING _upsert_source AS source ON target.store_id = source.store_id ")
    assert "UPDATE SET target.store_name = source.store_name, " in gold and "target.store_id = source.store_id," not in gold
    assert gold.endswith("INSERT (store_id, store_name, store_location, region, store_format, first_issue_date) VALUES "
                         "(source.store_id, source.store_name, source.store_location, source.region, source.store_format, source.first_issue_date)")
    assert "ON target.transaction_id = source.transaction_id AND target.product_id = source.product_id WHEN" in facts
    assert "payment_method" not in facts and "target.unit_price = source.unit_price" in facts
    with pytest.raises(ValueError, match="tables of files"):
        upsert_table(spark, f"{tmp_path}/gold", stores, ["store_id"], "delta", merge=lambda target, source: source)


def test_partitions_that_do_not_move_need_no_key_scan(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, v string, day string"
    upsert_table(spark, path, frame(spark, [(1, "a", "007"), (2, "b", "008")], schema), ["k"], partition_by=["day"])
    before = _dirs(path)
    upsert_table(
        spark, path, frame(spark, [(2, "B", "008")], schema), ["k"], partition_by=["day"], partitions_move=False
    )
    assert before["day=007"] == _dirs(path)["day=007"]
    assert rows(read_table(spark, path, schema=schema)) == [(1, "a", "007"), (2, "B", "008")]


def test_scratch_is_in_the_folder_the_session_names(spark, tmp_path):
    folder = files.scratch_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_upsert_twice_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert_table(spark, path, frame(spark, [(1, "a"), (2, "b")]), ["k"])
    batch = frame(spark, [(2, "B"), (3, "c")])
    for _ in range(2):
        upsert_table(spark, path, batch, ["k"])
        assert rows(read_table(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError, match="several source rows"):
        upsert_table(spark, path, frame(spark, [(2, "x"), (2, "y")]), ["k"])


def _dirs(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, v string, day string"
    upsert_table(spark, path, frame(spark, [(1, "a", "007"), (2, "b", "008")], schema), ["k"], partition_by=["day"])
    before = _dirs(path)
    upsert_table(spark, path, frame(spark, [(2, "B", "008"), (3, "c", "009")], schema), ["k"], partition_by=["day"])
    after = _dirs(path)
    assert before["day=007"] == after["day=007"] and before["day=008"] != after["day=008"]
    assert set(after) == {"day=007", "day=008", "day=009"}
    want = [(1, "a", "007"), (2, "B", "008"), (3, "c", "009")]
    assert rows(read_table(spark, path, schema=schema)) == want


@pytest.mark.parametrize("day", ["008", None])
def test_partitioned_upsert_of_a_moved_row_is_exact(spark, tmp_path, day):
    path, schema = f"{tmp_path}/t", "k int, v string, day string"
    upsert_table(spark, path, frame(spark, [(1, "a", "007"), (2, "b", "008")], schema), ["k"], partition_by=["day"])
    upsert_table(spark, path, frame(spark, [(1, "A", day)], schema), ["k"], partition_by=["day"])
    assert rows(read_table(spark, path, schema=schema)) == rows(
        frame(spark, [(1, "A", day), (2, "b", "008")], schema)
    )


def test_partition_columns_among_the_keys(spark, tmp_path):
    path, schema, keys = f"{tmp_path}/t", "k int, v string, day string", ["k", "day"]
    upsert_table(spark, path, frame(spark, [(1, "a", "007"), (2, "b", "008")], schema), keys, partition_by=["day"])
    before = _dirs(path)
    upsert_table(spark, path, frame(spark, [(1, "A", "008"), (2, "B", "008")], schema), keys, partition_by=["day"])
    assert before["day=007"] == _dirs(path)["day=007"]
    want = [(1, "A", "008"), (1, "a", "007"), (2, "B", "008")]
    assert rows(read_table(spark, path, schema=schema)) == want


def test_landed(spark, tmp_path):
    df = frame(spark, [(1, "2024-01-01"), (2, "2024-01-01")]).withColumn("ingestion_date", F.col("v").cast("date"))
    assert [tuple(r)[1:] for r in landed(df, "2024-01-01").collect()] == [(2, True)]
    assert [tuple(r)[1:] for r in landed(df, "2024-01-02").collect()] == [(0, False)]


def test_csv_load_and_bronze(spark, tmp_path):
    source, bronze = f"{tmp_path}/csv", f"{tmp_path}/bronze"
    os.mkdir(source)
    for name, line in {"a": "1,2020-01-01", "b": "2,"}.items():
        with open(f"{source}/{name}.csv", "w") as out:
            out.write("client_id,first_issue_date\n" + line + "\n")
    loads.ingest_folder(spark, source, bronze, as_of="2024-01-02 03:00:00", by_day=True)
    loads.ingest_folder(spark, source, bronze, as_of="2024-01-09 03:00:00", by_day=True)
    table = read_table(spark, bronze)
    assert table.count() == 4 and {r.client_id for r in table.collect()} == {"1", "2"}
    assert {os.path.basename(r.source_file) for r in table.collect()} == {"a.csv", "b.csv"}
    assert retail.silver_rows(table, ["client_id"], "2024-01-10").columns == ["client_id", "first_issue_date"]
    loads.load_csv(spark, "clients", f"{source}/a.csv", f"{tmp_path}/clients")
    assert read_table(spark, f"{tmp_path}/clients").dtypes == [("client_id", "int"), ("first_issue_date", "date")]
    loads.load_csv(spark, "stores", f"{source}/a.csv", f"{tmp_path}/stores", as_of="2024-01-01")
    assert dict(read_table(spark, f"{tmp_path}/stores").dtypes)["first_issue_date"] == "timestamp"


def test_a_file_with_another_header_fails(spark, tmp_path):
    source = f"{tmp_path}/csv"
    os.mkdir(source)
    for name, head in {"a": "x,y", "b": "y,x"}.items():
        with open(f"{source}/{name}.csv", "w") as out:
            out.write(head + "\n1,2\n")
    with pytest.raises(Exception):
        loads.ingest_folder(spark, source, f"{tmp_path}/bronze")


def test_export_is_one_file_where_the_caller_asks(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "concat(' ', id) AS t")
    export_csv(df, f"{tmp_path}/one", single_file=True)
    export_csv(df, f"{tmp_path}/many")
    assert len(glob.glob(f"{tmp_path}/one/*.csv")) == 1 and len(glob.glob(f"{tmp_path}/many/*.csv")) > 1
    for folder in ("one", "many"):
        back = read_csv(spark, f"{tmp_path}/{folder}", schema=layout("id int, t string"))
        assert sorted(r.t for r in back.collect()) == sorted(f" {i}" for i in range(1000))


def test_calendar(spark, tmp_path):
    first = calendar.first_dates(spark)
    assert first.count() == 118 and len(first.columns) == 13
    path = f"{tmp_path}/dim_times"
    publish(first, path)
    calendar.extend_dim_times(spark, path, "2019-03-19")
    assert read_table(spark, path).count() == 118
    calendar.extend_dim_times(spark, path, "2019-03-22")
    assert read_table(spark, path).count() == 121
    assert calendar.missing_dates(first.filter("false"), "2019-03-19").isEmpty()


def test_conform(spark):
    df = frame(
        spark,
        [("2019-01-01", "x", '["a","b"]', 5, "9"), ("bad", None, "plain", None, "z")],
        "d string, s string, labels string, n int, q string",
    ).withColumn("nested", F.struct("n")).withColumn("extra", F.lit(1))
    schema = "d date, s string, labels array<string>, n array<int>, nested string, q int, gone double"
    from pyspark.sql.types import StructType

    out = conform(df, StructType.fromDDL(schema))
    got = [tuple(r) for r in out.collect()]
    assert [str(got[0][0]), *got[0][1:]] == ["2019-01-01", "x", ["a", "b"], [5], '{"n":5}', 9, None]
    assert got[1] == (None, None, ["plain"], None, "{}", None, None)


def test_harmonize_first_hit_wins(spark):
    df = frame(spark, [("u", "p", "d")], "post_user string, user_url string, date_created string")
    assert harmonize(df, social_entities.RENAMES).columns == ["post_user", "user_posted", "comment_date"]


def test_align_union_fills_the_missing_column(spark):
    seven = frame(spark, [("1",)], "user_id string")
    eight = frame(spark, [("2", "TikTok")], "user_id string, user_type string")
    assert rows(align_union(seven, eight)) == [("1", None), ("2", "TikTok")]


def test_id_lists_hold_every_id_in_bounded_chunks(spark):
    hot = spark.range(1000).selectExpr("'hot' AS tag", "id").unionByName(spark.range(3).selectExpr("'few' AS tag", "id"))
    lists = id_lists(hot, "tag", "id", chunks=10).collect()
    assert sorted(i for r in lists if r.tag == "hot" for i in r.ids) == list(range(1000))
    assert len([r for r in lists if r.tag == "hot"]) == 10 and max(len(r.ids) for r in lists) < 200
    assert sorted(i for r in lists if r.tag == "few" for i in r.ids) == [0, 1, 2]
    assert all(0 <= r.chunk < 10 for r in lists)


def test_last_writer(spark):
    one, two = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "B")])
    assert rows(last_writer([one, two], "k", "v")) == [(1, "a"), (2, "B")]


def test_first_date_falls_back(spark):
    texts = frame(spark, [(1, "junk"), (2, "2024-01-05")])
    got = {r.k: str(r.first_date) for r in first_date(texts, "v", "2024-03-01", by=["k"]).collect()}
    assert got == {1: "2024-02-29", 2: "2024-01-04"}


def test_mentions_resolve_to_the_nearest_platform_so_far(spark):
    facebook = frame(spark, [("f/ann", "p/1", "x/ann"), ("f/bob", "p/2", "x/cat")],
                     "user_url string, post_url string, tagged_users string")
    twitter = frame(spark, [("ann", "t/3", " x/ann "), ("cat", "t/4", "x/bob"), ("dan", "t/5", None)],
                    "user_posted string, post_url string, tagged_users string")
    unified = social_entities.unify({"Facebook": facebook, "Twitter": twitter})
    names = {r.user_id: (r.type_of_account, r.display_name) for r in social_entities.users(unified).collect()}
    got = {r.post_id: names.get(r.mentioned_user_id) for r in social_entities.mentions(unified).collect()}
    assert got == {"1": ("Facebook", "ann"), "2": None, "3": ("Twitter", "ann"), "4": ("Facebook", "bob")}


def test_posts_need_both_columns_and_are_unique(spark):
    with_posts = frame(spark, [("u/a", "p/1/", "2024-01-05"), ("u/b", "p/1", "2024-01-03"), ("u/c", "p/2", None)],
                       "user_url string, post_url string, date_created string")
    without = frame(spark, [("u/z",)], "user_posted string")
    unified = social_entities.unify({"A": with_posts, "B": without})
    got = social_entities.posts(unified, "2024-02-01").collect()
    assert {(r.post_id, str(r.post_date)) for r in got} == {("1", "2024-01-02"), ("2", "2024-01-02")}
    assert social_entities.users(unified).count() == 4


def _csv(folder, name, header, lines):
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join([header, *lines]) + "\n")


def test_social_layers_end_to_end(spark, tmp_path):
    folder = str(tmp_path / "raw")
    os.mkdir(folder)
    _csv(folder, "facebook_datasets.csv", "user_id,user_name,user_url,post_id,post_url",
         ["1,Ann,f/ann,10,f/p/10", "1,Ann,f/ann,11,f/p/11"])
    from tillwater.sources.schemas import INSTAGRAM_COMMENTS, TIKTOK_COMMENTS, TWITTER_POSTS

    _csv(folder, "Instagram-datasets.csv", ",".join(INSTAGRAM_COMMENTS.names),
         ['u,c,https://i/bob/,2024-01-01,hi,x,,,"[""Sale"",""a""]",i/bob,p/1,o,1,123456789012'.replace('""', '\\"')])
    _csv(folder, "TikTok-datasets.csv", ",".join(TIKTOK_COMMENTS.names),
         [",,5,,,,few,2,,,https://www.tiktok.com/@eve,9,"])
    _csv(folder, "Twitter-datasets.csv", ",".join(TWITTER_POSTS.names),
         ["7,Dan Lee,Dan,text,2024-01-01,1,,x/Dan Lee,1,1,1,1,,sale,1,,1,,1,true,,,,,1,"])
    bronze, silver, gold = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold"))
    social_repair.load_platforms(spark, folder, bronze, as_of="2024-02-01")
    for since in (None, "2024-02-01"):  # a second run changes nothing
        read = platforms.refresh_silver(spark, bronze, silver, as_of="2024-02-01")
        assert read == ({} if since else {name: ["2024-02-01"] for name in platforms.PLATFORMS})
        social_star.refresh_gold(spark, silver, gold, since=since)
        users = read_table(spark, f"{silver}/user")
        assert users.drop("ingestion_date").columns == SILVER_USER.names
        assert {r.display_name for r in users.collect()} == {"Ann", "bob", "eve", "Dan Lee"}
        assert read_table(spark, f"{gold}/dim_user").count() == 4
        assert read_table(spark, f"{gold}/dim_post").count() == 5
        assert {r.hashtag_text for r in read_table(spark, f"{gold}/dim_hashtag").collect()} == {"sale", "a"}
        usage = read_table(spark, f"{gold}/fact_hashtag_usage").collect()
        assert len(usage) == 3 and {r.date_id for r in usage} == {1}
        named = {r.post_id: r.mentioned_user_id for r in read_table(spark, f"{gold}/fact_user_mention").collect()}
        assert named["7"] is not None and named["123456789012"] is not None


def test_retail_layers_end_to_end(spark, tmp_path):
    from workload.standins import frame as standin

    sf_dir = "/root/testdata/sf0.001"

    bronze, silver, facts = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "facts"))
    publish(standin(spark, sf_dir, "bronze_purchases"), bronze)
    for as_of, since in (("1999-01-08", None), ("2000-01-08", "2000-01-01"), ("2000-01-08", "2000-01-01")):
        retail.refresh_silver(spark, "purchases", bronze, silver, as_of)
        # only the silver rows that came in since the last run are folded in
        sales.refresh_facts(spark, silver, facts, partition_by=["store_id"], since=since)
        table = read_table(spark, facts)
        assert table.count() == read_table(spark, silver).count()
        assert table.groupBy("transaction_id", "product_id").count().filter("count > 1").isEmpty()
    clients = standin(spark, sf_dir, "clients").select(*CLIENTS.names)
    publish(clients, f"{tmp_path}/clients")
    for _ in range(2):
        retail.refresh_gold(spark, "clients", f"{tmp_path}/clients", f"{tmp_path}/gold")
        gold = read_table(spark, f"{tmp_path}/gold")
        assert gold.columns == retail.GOLD_COLUMNS["clients"]
        assert gold.count() == clients.filter("client_id IS NOT NULL").count()


def test_warehouse_build(spark, tmp_path, sf_dir):
    from workload.standins import frame as standin

    tables = [standin(spark, sf_dir, n) for n in ("clients", "products", "purchases", "stores")]
    sales.build_warehouse(*tables, calendar.first_dates(spark), f"{tmp_path}/warehouse")
    assert read_table(spark, f"{tmp_path}/warehouse/fact_sales").columns == sales.INITIAL_COLUMNS
    assert sorted(os.listdir(f"{tmp_path}/warehouse")) == [
        "clients", "dim_times", "fact_sales", "products", "stores",
    ]


def test_cross_platform_layers_end_to_end(spark, tmp_path):
    paths = {}
    for name in ("Facebook", "Twitter"):
        paths[name] = f"{tmp_path}/{name}-datasets.csv"
        _csv(str(tmp_path), f"{name}-datasets.csv", "user_url,post_url,date_created,hashtag_comment,tagged_users",
             [f"u/{name},p/1,2024-01-05, Sale ,u/{name}", f"u/{name},p/2,2024-01-03,sale,u/none"])
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    assert set(social_entities.platform_files(spark, str(tmp_path))) == set(paths)
    social_entities.load_entities(spark, str(tmp_path), bronze, as_of="2024-02-01")
    social_entities.refresh_silver(spark, bronze, silver)
    assert set(social_entities.refresh_silver(spark, bronze, silver)) == set()
    posts = read_table(spark, f"{silver}/dim_posts").collect()
    # Moved back by one day once, not once per layer.
    assert {str(r.post_date) for r in posts} == {"2024-01-02"} and len(posts) == 4
    assert read_table(spark, f"{silver}/dim_hashtags").count() == 2
    assert read_table(spark, f"{silver}/fact_user_mentions").filter("mentioned_user_id IS NULL").count() == 2  # one a platform


def test_every_csv_of_a_folder_is_loaded(spark, tmp_path):
    for name in ("facebook_datasets.csv", "Twitter-1.CSV", "Twitter-[2].csv"):
        _csv(str(tmp_path), name, "user_url,post_url", [f"u/{name[-7:-4]},p/{name[:3]}"])
    (tmp_path / "notes.txt").write_text("user_url\nu/none\n")
    social_entities.load_entities(spark, str(tmp_path), f"{tmp_path}/bronze", as_of="2024-02-01")
    users = read_table(spark, f"{tmp_path}/bronze/dim_users").collect()
    assert sorted((r.type_of_account, r.display_name) for r in users) == [
        ("Twitter", "[2]"), ("Twitter", "r-1"), ("facebook_datasets.csv", "ets"),
    ]


def test_files_of_a_platform_are_aligned_by_name(spark, tmp_path):
    _csv(str(tmp_path), "facebook-a.csv", "user_url,post_url,hashtag_comment", ["x/u1,x/p1,sale", "x/u2,x/p2,new"])
    _csv(str(tmp_path), "facebook-b.csv", "post_url,hashtag_comment,user_url", ["x/p3,old,x/u3", ",none,x/u4", ",none,x/u5"])
    _csv(str(tmp_path), "facebook-c.csv", "user_url", ["x/u6"])  # a layout without posts
    (tmp_path / "facebook-d.csv").write_text("")
    bronze = f"{tmp_path}/bronze"
    social_entities.load_entities(spark, str(tmp_path), bronze, as_of="2024-02-01")
    read = lambda name, *columns: rows(read_table(spark, f"{bronze}/{name}").select(*columns))
    assert read("dim_users", "display_name") == [(f"u{k}",) for k in range(1, 7)]
    assert read("dim_posts", "post_id") == [("p1",), ("p2",), ("p3",)]
    assert read("dim_hashtags", "hashtag_text") == [("new",), ("none",), ("old",), ("sale",)]
    # posts without any id stay apart
    assert read("post_rejected", "platform", "post_url") == [("facebook", None)] * 2


def test_a_load_replaces_its_platforms_only(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for name in ("A", "B"):
        os.mkdir(tmp_path / name)
        _csv(f"{tmp_path}/{name}", f"{name}-1.csv", "user_url,post_url,tagged_users", [f"u/{name},p/1,u/{name}"])
        social_entities.load_entities(spark, f"{tmp_path}/{name}", bronze, as_of="2024-02-01")
    assert social_entities.refresh_silver(spark, bronze, silver)["dim_posts"] == ["A", "B"]
    before = _dirs(f"{silver}/dim_posts")
    _csv(f"{tmp_path}/B", "B-1.csv", "user_url,post_url", ["u/B,p/7"])  # no mentions any more
    social_entities.load_entities(spark, f"{tmp_path}/B", bronze, as_of="2024-02-01")
    assert social_entities.refresh_silver(spark, bronze, silver)["dim_posts"] == ["B"]
    assert _dirs(f"{silver}/dim_posts")["platform=A"] == before["platform=A"]
    posts = read_table(spark, f"{silver}/dim_posts").select("platform", "post_id")
    assert rows(posts.withColumn("post_id", F.col("post_id").cast("string"))) == [("A", "1"), ("B", "7")]
    assert [r.platform for r in read_table(spark, f"{silver}/fact_user_mentions").collect()] == ["A"]
    assert social_entities.refresh_silver(spark, bronze, silver) == {}


def _instagram_day(spark, bronze, day, data):
    schema = "comment_user_url string, post_id string, post_url string, hashtag_comment string, tagged_users_in_comment string"
    came = {"ingestion_time": F.lit(day).cast("timestamp"), "ingestion_date": F.lit(day).cast("date")}
    publish(frame(spark, data, schema).withColumns(came), f"{bronze}/instagram", "append", partition_by=["ingestion_date"])


def test_a_second_run_reads_its_own_day_only(spark, tmp_path):
    bronze, silver, gold = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold"))
    ann, bob = "https://www.instagram.com/ann/", "https://www.instagram.com/bob/"
    _instagram_day(spark, bronze, "2024-02-01", [(ann, "1", "p/1", '["sale"]', "bob"), (ann, "2", "p/2", None, "zoe")])
    assert platforms.refresh_silver(spark, bronze, silver, as_of="2024-02-01") == {"instagram": ["2024-02-01"]}
    social_star.refresh_gold(spark, silver, gold)
    _instagram_day(spark, bronze, "2024-02-02", [(bob, "3", "p/3", '["new"]', "ann"), (ann, "1", "p/1", '["sale"]', "bob")])
    todo = manifest.pending(spark, f"{silver}/manifest", "instagram", f"{bronze}/instagram", "ingestion_date")
    batch = manifest.chosen(read_table(spark, f"{bronze}/instagram"), "ingestion_date", todo)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cast\(ingestion_date#\d+ as string\) = 2024-02-02", plan)
    assert {os.path.basename(os.path.dirname(r[0])) for r in batch.select(F.input_file_name()).collect()} == {"ingestion_date=2024-02-02"}
    for want in ({"instagram": ["2024-02-02"]}, {}):
        assert platforms.refresh_silver(spark, bronze, silver, as_of="2024-02-02") == want
        social_star.refresh_gold(spark, silver, gold, since="2024-02-02")
        names = {r.user_id: r.display_name for r in read_table(spark, f"{silver}/user").collect()}
        assert set(names.values()) == {"ann", "bob"}
        posts = {r.post_id: str(r.post_date)[:10] for r in read_table(spark, f"{silver}/post").collect()}
        assert posts == {"1": "2024-01-31", "2": "2024-01-31", "3": "2024-02-01"}
        found = read_table(spark, f"{gold}/fact_user_mention").collect()
        got = {(r.post_id, r.mentioned_name): (names.get(r.mentioned_user_id), r.date_id) for r in found}
        # bob was not known on the first day
        assert got == {("1", "bob"): ("bob", 1), ("2", "zoe"): (None, 1), ("3", "ann"): ("ann", 2)} and len(found) == 3
        usage = read_table(spark, f"{gold}/fact_hashtag_usage").select("post_type", "post_id", "date_id")
        assert rows(usage) == [("Instagram", "1", 1), ("Instagram", "3", 2)]
    assert platforms.refresh_silver(spark, bronze, silver, as_of="2024-02-02") == {}


def test_a_late_file_makes_its_day_new_again(spark, tmp_path):
    table, notes = f"{tmp_path}/t", f"{tmp_path}/manifest"
    assert manifest.pending(spark, notes, "t", table, "day") == {}
    rows_ = frame(spark, [(1, "a b"), (2, None)], "k int, day string")
    publish(rows_, table, partition_by=["day"])
    todo = manifest.pending(spark, notes, "t", table, "day")
    assert set(todo) == {"a b", manifest.NULL_FOLDER}
    chosen = lambda values: [r.k for r in manifest.chosen(read_table(spark, table), "day", values).collect()]
    assert sorted(chosen(todo)) == [1, 2] and chosen(["a b"]) == [1] and chosen([manifest.NULL_FOLDER]) == [2]
    manifest.record(spark, notes, {"t": todo})
    assert manifest.pending(spark, notes, "t", table, "day") == {}
    publish(frame(spark, [(3, "a b")], "k int, day string"), table, "append", partition_by=["day"])
    assert set(manifest.pending(spark, notes, "t", table, "day")) == {"a b"}
    files.delete(spark, f"{table}/day=a b")
    assert manifest.pending(spark, notes, "t", table, "day") == {"a b": manifest.GONE}
    manifest.record(spark, notes, {"t": {"a b": manifest.GONE}})
    assert manifest.pending(spark, notes, "t", table, "day") == {}


def test_one_id_on_two_platforms(spark):
    posts = frame(spark, [("A", "9", "2024-01-01"), ("B", "9", "2024-03-05"), ("B", "9", "2024-03-01"), ("B", "8", None)],
                  "post_type string, post_id string, post_date string")
    dates = frame(spark, [("2024-01-01", 7), ("2024-03-01", 3), ("2024-03-05", 1)], "full_date string, date_id int")
    dated = social_star.post_dates(posts, dates.withColumn("full_date", F.to_date("full_date")))
    assert rows(dated) == [("A", "9", 7), ("B", "8", None), ("B", "9", 3)]  # the earliest day, whatever its id
    links = frame(spark, [("A", "9", "t"), ("B", "9", "t"), ("C", "9", "t")], "post_type string, post_id string, hashtag_id string")
    assert rows(social_star.hashtag_usage(links, dated).select("usage_id", "date_id")) == [("A_9_t", 7), ("B_9_t", 3), ("C_9_t", None)]


def test_a_feed_replaces_the_edges_of_its_products_only(spark, tmp_path):
    schema = "id string, product_name string, price double, categories string"
    listed = lambda *ids: "[" + ",".join('{"categoryId":"%s"}' % c for c in ids) + "]"
    shop, edges = f"{tmp_path}/shop", lambda: rows(read_table(spark, f"{tmp_path}/shop/category_edges"))
    first = [(f"v1|{k}|0", "n", 1.0, listed("a", "b")) for k in range(1, 9)] + [("v1|x|0", "n", 1.0, listed("z"))]
    marketplace.refresh(spark, frame(spark, first, schema), shop, layout=["bucket_of_8"])
    assert edges() == [(k, c) for k in range(1, 9) for c in "ab"]
    before = _dirs(f"{shop}/category_edges")
    second = frame(spark, [("v1|2|0", "new", 2.0, listed("b", "c", "c")), ("v1|9|0", "n", 1.0, "junk"), ("v1|3|0", "n", 1.0, None)], schema)
    want = [(k, c) for k in range(1, 9) for c in {2: "bc", 3: ""}.get(k, "ab")]
    for _ in range(2):
        marketplace.refresh(spark, second, shop, layout=["bucket_of_8"])
        assert edges() == want
    after = _dirs(f"{shop}/category_edges")
    assert any(before[d] == after.get(d) for d in before) and any(before[d] != after.get(d) for d in before)
    assert {r.product_id: r.product_name for r in read_table(spark, f"{shop}/products").collect()}[2] == "new"
    nothing = frame(spark, [(f"v1|{k}|0", "n", 1.0, None) for k in range(1, 10)], schema)
    marketplace.refresh(spark, nothing, shop, layout=["bucket_of_8"])
    assert edges() == [] and read_table(spark, f"{shop}/category_edges").columns == ["product_id", "category_id"]


def test_a_key_of_two_folders_is_matched_in_both(spark, tmp_path):
    path, schema, maps = f"{tmp_path}/t", "k int, v string, day int", ColumnMap(
        {"v": "source.v", "day": "source.day"}, {"k": "source.k", "v": "source.v", "day": "source.day"}
    )
    old = [(1, "a", 20240105), (1, "b", 20240228), (2, "c", 20240201)]
    publish(frame(spark, old, schema), path, partition_by=["div_100_of_day"], keys=["k"])
    publish(frame(spark, [(1, "A", 20240106), (2, "C", 20240202)], schema), f"{tmp_path}/batch")
    batch = read_table(spark, f"{tmp_path}/batch")
    upsert_table(spark, path, batch, ["k"], columns=maps, partitions_move=False, stored=True)
    assert rows(read_table(spark, path)) == [(1, "A", 20240106), (1, "A", 20240106), (2, "C", 20240202)]


def test_a_stored_batch_is_merged_by_folder_without_staging(spark, tmp_path, monkeypatch):
    from tillwater.sources import tables

    path, schema = f"{tmp_path}/t", "k int, v string, day int"
    maps = ColumnMap({"v": "source.v"}, {"k": "source.k", "v": "source.v", "day": "source.day"})
    publish(frame(spark, [(1, "a", 20240105), (2, "b", 20240228)], schema), path, partition_by=["div_100_of_day"], keys=["k"])
    publish(frame(spark, [(2, "B", 20240227), (3, "c", 20240301)], schema), f"{tmp_path}/batch")
    monkeypatch.setattr(tables, "stage", None)
    monkeypatch.setattr(tables, "_gathered", None)  # no second shuffle
    monkeypatch.setattr(tables, "ROWS_AT_ONCE", 1)
    batch = read_table(spark, f"{tmp_path}/batch")
    upsert_table(spark, path, batch, ["k"], columns=maps, partitions_move=False, stored=True)
    assert rows(read_table(spark, path)) == [(1, "a", 20240105), (2, "B", 20240228), (3, "c", 20240301)]
