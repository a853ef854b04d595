"""SQL snippets for the checks, in DuckDB's dialect."""

from __future__ import annotations

from tillwater.functions.text import FALLBACK_NAMES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def number_of(digest_input: str) -> str:
    return f"CAST('0x' || substr(md5({digest_input}), 1, 15) AS BIGINT)"


def hash_number(*keys: str) -> str:
    return number_of("concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")")


def _measured(key: str) -> str:
    as_text = f"CAST({key} AS VARCHAR)"
    return f"CAST(length({as_text}) AS VARCHAR) || ':' || {as_text}"


def hash_id(*keys: str) -> str:
    return "md5(" + " || ".join(_measured(k) for k in keys) + ")"


def row_id(scope: str, *columns: str) -> str:
    return f"md5('{scope};' || " + " || ".join(f"coalesce({_measured(c)}, '~')" for c in columns) + ")"


def parsed_long(column: str) -> str:
    """A whole number that fits a bigint, as text; else NULL."""
    as_text = f"trim(CAST({column} AS VARCHAR))"
    return (
        f"CASE WHEN regexp_full_match({as_text}, '[+-]?[0-9]+') "
        f"THEN CAST(TRY_CAST({as_text} AS BIGINT) AS VARCHAR) END"
    )


def pick_int(low: int, high: int, *keys: str) -> str:
    return f"({low} + {hash_number(*keys)} % {high - low + 1})"


def digits_id(digits: int, *keys: str) -> str:
    return pick_int(10 ** (digits - 1), 10**digits - 1, *keys)


def pick(options: list[str], *keys: str) -> str:
    listed = ", ".join(text(o) for o in options)
    return f"[{listed}][1 + {hash_number(*keys)} % {len(options)}]"


def fallback_name(*keys: str) -> str:
    return pick(FALLBACK_NAMES, *keys)


def parsed_int(column: str) -> str:
    """An int if the trimmed text is digits within range, else NULL."""
    as_text = f"trim(CAST({column} AS VARCHAR))"
    return (
        f"CASE WHEN regexp_full_match({as_text}, '[+-]?[0-9]+') THEN TRY_CAST({as_text} AS INTEGER) END"
    )


def last_segment(url: str) -> str:
    return f"nullif(string_split(rtrim({url}, '/'), '/')[-1], '')"


def unquoted(value: str) -> str:
    return f"trim(trim({value}), '\"')"


def tags(column: str, bracketed: bool) -> str:
    trimmed = f"trim({column})"
    body = f"{trimmed}[2:-2]" if bracketed else trimmed
    return f"""CASE WHEN {column} IS NULL OR {trimmed} IN ('', 'unknown') OR lower({trimmed}) = 'null'
        THEN []::VARCHAR[]
        ELSE list_distinct(list_filter(list_transform(string_split({body}, ','), lambda x: {unquoted('x')}),
             lambda x: x NOT IN ('', 'unknown', 'null_hehe"_hehe') AND trim(lower(x)) <> 'null')) END"""


def calendar(day: str) -> str:
    return f"""
    {day} AS full_date,
    CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_key,
    strftime({day}, '%A') AS day_of_week,
    CAST(dayofweek({day}) + 1 AS INTEGER) AS day_number_of_week,
    CAST(dayofmonth({day}) AS INTEGER) AS day_of_month,
    CAST(dayofyear({day}) AS INTEGER) AS day_of_year,
    CAST(weekofyear({day}) AS INTEGER) AS week_of_year,
    CAST(month({day}) AS INTEGER) AS month,
    strftime({day}, '%B') AS month_name,
    CAST(quarter({day}) AS INTEGER) AS quarter,
    CAST(year({day}) AS INTEGER) AS year,
    CASE WHEN dayofweek({day}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    0 AS is_holiday"""


def first_row(columns: str, source: str, keys: str, order: str) -> str:
    """One row per key in the given order."""
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""
