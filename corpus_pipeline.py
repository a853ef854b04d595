"""The corpus pipeline: each stage works on all that the one before it kept.

Rows of ``documents`` pass the quality classifier, the quality rules and near-duplicate removal,
are mixed to the sources' target weights (a row may then come twice), and are packed into
sequences; the last stage gives one row per piece. Rows with NULLs, empty texts, repeated rows
and extra columns follow the stage's operator, see there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwater.llm import mixing, near_dedup, packing, quality_classifier, quality_rules
from tillwater.llm.common import scratch_path, table
from tillwater.sources import files

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer does not reject."""
    return quality_classifier.keep(docs)


def rule(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep(docs, size=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("quality rules", rule),
    ("near dedup", deduplicate),
    ("mixing", mix),
    ("packing", pack),
]

#: No SQL: trained models, MinHash, hashed draws and a tokenizer decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one gives is written, read by the next one, and then deleted."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            files.delete(spark, f"{base}/{k - 1}")
    return docs
