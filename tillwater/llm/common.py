"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
WORD = r"[^ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    r"""The words ``[^\x20\x09-\x0D]+`` of a text; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset (as in tests), one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, so that a lost executor costs no rerun."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def constants(values: list[float]) -> Column:
    """A fixed-size list of numbers as one constant array."""
    return F.split(F.lit(",".join(f"{v:.9g}" for v in values)), ",").cast("array<double>")


def whole_rows(df: DataFrame) -> Column:
    """All columns in one struct, so that columns added beside it cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def where_late(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)``, evaluated on the columns as they stand.

    A plain filter is pushed below the projections that make its columns, where it computes
    them again, nested into each other. A column that may not be computed twice holds it back.
    """
    fenced = df.withColumn("_fence", F.monotonically_increasing_id())
    return fenced.where(condition & (F.col("_fence") >= 0)).drop("_fence")
