"""Functions under a name that SQL text can call.

They are SQL functions, so the optimizer inlines their expression into the query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillwater.functions.text import NULL_TAG, PLACEHOLDER_TAG

# The pairs of functions.text.tag_pairs, written as one SQL expression.
_PAIRS = f"""
coalesce(
  filter(
    transform(
      filter(
        transform(
          split(trim(BOTH '[]' FROM trim(list)),
                CASE WHEN contains(list, ';') THEN ';' ELSE ',' END),
          part -> trim(BOTH '"' FROM trim(part))),
        part -> instr(part, ':') > 0),
      part -> named_struct(
        'key', trim(substring_index(part, ':', 1)),
        'value', trim(substring(part, instr(part, ':') + 1)))),
    pair -> pair.key <> '' AND pair.value NOT IN ('', '{PLACEHOLDER_TAG}')
            AND lower(pair.value) <> '{NULL_TAG}'),
  CAST(array() AS ARRAY<STRUCT<key: STRING, value: STRING>>))
"""


def register_functions(spark: SparkSession) -> None:
    """Make ``parse_hashtags(list)`` callable from SQL in this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION parse_hashtags(list STRING) "
        f"RETURNS ARRAY<STRUCT<key: STRING, value: STRING>> RETURN {_PAIRS}"
    )
