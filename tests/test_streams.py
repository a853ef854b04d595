"""The product stream: parsing, quarantine, restart, time limit."""

import os

import pytest
from helpers import rows
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tillwater.streaming import products


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


GOOD = '{"productId":1,"ProductName":"cup","brandName":"b","Price":2.5,"categoryIds":[7,8]}'


def test_good_and_bad_messages(spark):
    messages = spark.createDataFrame(
        [(GOOD,), ('{"productid":2}',), ("junk",), ('{"productId":"x"}',), (None,)], "value string"
    )
    got = products.bronze_products(products.product_rows(messages, "2024-01-02")).drop("first_issue_date")
    assert rows(got) == [("1", "7", "8", None, None, "b", "cup", 2.5)]
    bad = products.quarantined(messages, "2024-01-02")
    assert rows(bad.select("message")) == [("junk",), ('{"productId":"x"}',), ('{"productid":2}',), (None,)]


def test_restart_adds_no_rows_and_partitions_by_date(spark, tmp_path):
    source, out, bad, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "bad", "ckpt"))
    _write(source, "a.txt", [GOOD, "junk"])
    for _ in range(2):
        products.listen(products.read_message_files(spark, source), out, bad, checkpoint, drain=True)
        assert spark.read.parquet(out).count() == 1 and spark.read.parquet(bad).count() == 1
    _write(source, "b.txt", [GOOD.replace("1", "5", 1)])
    products.listen(products.read_message_files(spark, source), out, bad, checkpoint, drain=True)
    assert {r.product_id for r in spark.read.parquet(out).collect()} == {"1", "5"}
    assert all(d.startswith(("ingestion_date=", "_", ".")) for d in os.listdir(out))


def test_a_batch_that_is_run_again_adds_nothing_twice(spark, tmp_path, monkeypatch):
    source, out, bad, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "bad", "ckpt"))
    _write(source, "a.txt", [GOOD, "junk"])
    write, stops = products._write_batch, [True]

    def stopping(rows_, path, number):
        if path == bad and stops.pop() if stops else False:
            raise RuntimeError("stopped between the two writes")
        write(rows_, path, number)

    monkeypatch.setattr(products, "_write_batch", stopping)
    with pytest.raises(StreamingQueryException, match="between the two"):
        products.listen(products.read_message_files(spark, source), out, bad, checkpoint, drain=True)
    assert spark.read.parquet(out).count() == 1 and not os.path.exists(bad)
    products.listen(products.read_message_files(spark, source), out, bad, checkpoint, drain=True)
    assert spark.read.parquet(out).count() == 1 and spark.read.parquet(bad).count() == 1


def test_a_batch_run_again_on_another_day_replaces_its_folders(spark, tmp_path):
    out, bad = f"{tmp_path}/out", f"{tmp_path}/bad"
    messages = spark.createDataFrame([(GOOD,), ("junk",)], "value string")
    for number, day in ((0, "2024-01-01"), (1, "2024-01-01"), (1, "2024-01-02")):
        products.write_both(messages, number, out, bad, day)
    for path in (out, bad):
        days = [(r.batch, str(r.ingestion_date)) for r in spark.read.parquet(path).collect()]
        assert sorted(days) == [(0, "2024-01-01"), (1, "2024-01-02")]


def test_time_limit_stops_the_query(spark, tmp_path):
    _write(f"{tmp_path}/in", "a.txt", [GOOD])
    stream = products.product_rows(products.read_message_files(spark, f"{tmp_path}/in"))
    query = products.write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", every="1 second")
    products.run_for([query], minutes=0.05)
    assert not query.isActive


def test_a_drain_has_no_time_limit(spark, tmp_path):
    source, out, bad, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "bad", "ckpt"))
    for k in range(6):
        _write(source, f"{k}.txt", [GOOD.replace("1", str(k + 1), 1), f"junk {k}"])
    messages = products.read_message_files(spark, source, files_per_trigger=1)
    products.listen(messages, out, bad, checkpoint, minutes=0.0001, drain=True)
    assert spark.read.parquet(out).count() == 6 and spark.read.parquet(bad).count() == 6


def test_a_failed_query_stops_the_others_and_is_raised(spark, tmp_path):
    _write(f"{tmp_path}/in", "a.txt", [GOOD])
    messages = products.read_message_files(spark, f"{tmp_path}/in")
    broken = messages.select(F.raise_error(F.lit("boom")).cast("string").alias("message"), F.lit(1).alias("day"))
    queries = [
        products.write_stream(products.product_rows(messages), f"{tmp_path}/a", f"{tmp_path}/ca", "1 second"),
        products.write_stream(broken, f"{tmp_path}/b", f"{tmp_path}/cb", "1 second", partition_by=["day"]),
    ]
    with pytest.raises(StreamingQueryException, match="boom"):
        products.run_for(queries, minutes=1)
    assert not any(query.isActive for query in queries)


def test_broker_options():
    assert products.broker_options("b:9092", "t", "earliest", True, 5) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5",
    }
    assert products.broker_options("b:9092", "t")["failOnDataLoss"] == "false"


def test_the_broker_source_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        products.read_messages(spark, "localhost:9092", "new_product", max_offsets_per_trigger=1000)


def test_stream_parses_each_message_once(spark):
    plan = products.product_rows(spark.createDataFrame([(GOOD,)], "value string"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
