"""Replace values that do not parse by a default; keep the valid ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwater.functions.dates import days_before


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# Whole numbers of a bigint's length, with blanks around them.
WHOLE_NUMBER = r"^\s*[+-]?0*[0-9]{1,19}\s*$"
INT_RANGE = (-(2**31), 2**31 - 1)


def parsed_long(column: Column | str) -> Column:
    """A bigint from text, NULL where the text is none.

    The pattern comes first since a failing string cast is costly: it builds an
    exception for each bad row, about ten times the price of the pattern.
    """
    text = _col(column).cast("string")
    return F.when(F.rlike(text, F.lit(WHOLE_NUMBER)), text.try_cast("bigint"))


def parsed_int(column: Column | str) -> Column:
    """An int from text, NULL where the text is none."""
    number = parsed_long(column)
    return F.when(number.between(*INT_RANGE), number.cast("int"))


def repair_int(column: Column | str, default: Column, is_int: bool = False) -> Column:
    """The int a text holds, else the default; an int column only has its NULLs filled."""
    value = _col(column) if is_int else parsed_int(column)
    return F.coalesce(value, default.cast("int"))


def repair_number_id(column: Column | str, default: Column) -> Column:
    """An id that is a whole number of up to 64 bits, as text without blanks; else the default."""
    return F.coalesce(parsed_long(column).cast("string"), default)


def repair_text_id(column: Column | str, default: Column) -> Column:
    """A text id as it is; the default where it is NULL or blank."""
    text = _col(column).cast("string")
    return F.when(F.trim(text) != "", text).otherwise(default)


def repair_ts(column: Column | str, as_of, days: int) -> Column:
    return F.coalesce(_col(column).try_cast("timestamp"), days_before(as_of, days))


def repair_id(column: Column | str, default: Column, digits: int = 12) -> Column:
    text = _col(column).cast("string")
    return F.when(F.rlike(text, F.lit(f"^[0-9]{{{digits}}}$")), text.try_cast("bigint")).otherwise(
        default
    )


def repair_name(
    column: Column | str, default: Column, sentinels: list[str], prefixes: list[str]
) -> Column:
    """The default for a sentinel or a rejected prefix; NULL stays NULL."""
    text = _col(column)
    rejected = text.isin(*sentinels)
    for prefix in prefixes:
        rejected = rejected | text.startswith(prefix)
    return F.when(rejected, default).otherwise(text)


def repair_text(column: Column | str, default: str = "unknown") -> Column:
    return F.coalesce(_col(column), F.lit(default))


def repair_url(column: Column | str, prefix: str, key: Column | str | None = None) -> Column:
    made = F.lit(prefix) if key is None else F.concat(F.lit(prefix), _col(key).cast("string"))
    return F.coalesce(_col(column), made)
