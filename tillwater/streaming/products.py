"""Product messages: JSON stream to typed bronze rows, bad messages to quarantine.

Stateless: each micro-batch is a projection, so there is nothing to shuffle or keep.  One
query reads the topic; each batch is parsed once, and both outputs are written from what was
parsed.  A batch that is run again, after a stop between the two writes or before Spark noted it
as done, replaces what it had written: every batch has partition folders of its own.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tillwater.functions.dates import as_timestamp
from tillwater.functions.text import level
from tillwater.sources import files
from tillwater.sources.schemas import PRODUCT_MESSAGE, PRODUCTS
from tillwater.sources.tables import stage

CORRUPT = "_corrupt_record"
PARTITION = "ingestion_date"
#: The batch that wrote a row; with the run's first day it names the folder that a repeated batch replaces.
BATCH = "batch"


def broker_options(
    brokers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """The connector's options: where to read, from where on, and whether lost offsets are an error."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_messages(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A Kafka topic as a stream; needs the Kafka connector on the class path."""
    options = broker_options(brokers, topic, starting_offsets, fail_on_data_loss, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def read_message_files(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Text files with one message per line, as a stream with a ``value`` column."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def parse_json(column: Column, schema: StructType) -> Column:
    """JSON text to a struct; text that does not fit the schema is kept in _corrupt_record."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return F.from_json(column, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})


def _parsed(messages: DataFrame) -> DataFrame:
    """(message, p, fits).  Exploding a one-entry array makes the parsed struct a column of
    its own: a filter on it cannot be pushed below, where it would parse the text again."""
    text = messages.select(F.col("value").cast("string").alias("message"))
    one_entry = F.array(parse_json(F.col("message"), PRODUCT_MESSAGE))
    parsed = text.select("message", F.explode(one_entry).alias("p"))
    # Without a message there is no struct, a message that fits has no corrupt text, and a
    # product has an id.
    fits = F.col("p").isNotNull() & F.col(f"p.{CORRUPT}").isNull() & F.col("p.productId").isNotNull()
    return parsed.withColumn("fits", fits)


def _typed(parsed: DataFrame, stamp: Column) -> DataFrame:
    return parsed.filter("fits").select("p.*").select(
        F.col("productId").cast("string").alias("product_id"),
        *[level("categoryIds", n).alias(f"level_{n}") for n in (1, 2, 3, 4)],
        F.col("brandName").alias("brand_name"),
        F.col("ProductName").alias("product_name"),
        F.col("Price").cast("double").alias("product_price"),
        stamp.alias("first_issue_date"),
        stamp.alias("ingestion_time"),
        F.to_date(stamp).alias(PARTITION),
    )


def _bad(parsed: DataFrame, stamp: Column) -> DataFrame:
    return parsed.filter("NOT fits").select("message", stamp.alias("ingestion_time"), F.to_date(stamp).alias(PARTITION))


def product_rows(messages: DataFrame, as_of=None) -> DataFrame:
    """Typed product rows of the messages that fit, with ingestion time and date."""
    return _typed(_parsed(messages), as_timestamp(as_of))


def quarantined(messages: DataFrame, as_of=None) -> DataFrame:
    """The messages that do not fit, unchanged."""
    return _bad(_parsed(messages), as_timestamp(as_of))


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str = "1 minute",
    drain: bool = False,
    partition_by: Sequence[str] = (PARTITION,),
) -> StreamingQuery:
    """Append to partitioned Parquet every minute; ``drain`` reads what is there and ends."""
    trigger = {"availableNow": True} if drain else {"processingTime": every}
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def run_for(queries: Sequence[StreamingQuery], minutes: float = 30) -> None:
    """Wait until all queries have ended, at most ``minutes`` (0 = no limit), then stop them.

    The first query that fails stops the others, and its error is raised.
    """
    deadline = time.monotonic() + minutes * 60 if minutes > 0 else None
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                if query.exception() is not None:
                    raise query.exception()
            if deadline is not None and time.monotonic() >= deadline:
                break
            next(query for query in queries if query.isActive).awaitTermination(1)
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def _write_batch(rows: DataFrame, path: str, number: int) -> None:
    """Write a batch's rows into folders of its number, in place of those of an earlier try.

    An earlier try may have been on another day, so its folders are looked up and not only overwritten.
    """
    spark = rows.sparkSession
    if files.exists(spark, path):
        for day in files.subfolders(spark, path):
            if day.startswith(f"{PARTITION}="):
                files.delete(spark, f"{path}/{day}/{BATCH}={number}")
    rows.withColumn(BATCH, F.lit(number)).write.partitionBy(PARTITION, BATCH).mode("append").parquet(path)


def write_both(messages: DataFrame, number: int, path: str, quarantine_path: str, as_of=None) -> None:
    """Parse a batch once, and write its products and its bad messages."""
    stamp = F.lit(messages.sparkSession.range(1).select(as_timestamp(as_of)).first()[0])
    parsed, staged = stage(_parsed(messages), "messages")
    try:
        _write_batch(_typed(parsed, stamp), path.rstrip("/"), number)
        _write_batch(_bad(parsed, stamp), quarantine_path.rstrip("/"), number)
    finally:
        files.delete(messages.sparkSession, staged)


def listen(
    messages: DataFrame,
    path: str,
    quarantine_path: str,
    checkpoint: str,
    minutes: float = 30,
    drain: bool = False,
    every: str = "1 minute",
) -> None:
    """Products to ``path`` and bad messages to ``quarantine_path`` until the time is up.

    ``drain`` reads all there is, however long that takes.  The paths belong to one ``checkpoint``, whose
    batch numbers they are laid out by.
    """
    trigger = {"availableNow": True} if drain else {"processingTime": every}
    query = (
        messages.writeStream.foreachBatch(lambda batch, number: write_both(batch, number, path, quarantine_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    run_for([query], 0 if drain else minutes)


def bronze_products(rows: DataFrame) -> DataFrame:
    """Only the product columns, in table order."""
    return rows.select(*PRODUCTS.names)
