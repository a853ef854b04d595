"""Deterministic numbers, ids and picks derived from a key.

They stand where a random draw would be: the same key gives the same value on
every run, on every executor and after a lost task is recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits are 60 bits: non-negative in a bigint.
_HEX_DIGITS = 15


def _as_text(key: Column | str) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return column.cast("string")


def _digest_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def row_numbers(*columns: str) -> tuple[Column, Column]:
    """Two independent 60-bit numbers from one md5 over the columns of a row."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    first, second = F.substring(digest, 1, _HEX_DIGITS), F.substring(digest, 16, _HEX_DIGITS)
    return F.conv(first, 16, 10).cast("bigint"), F.conv(second, 16, 10).cast("bigint")


def draws(number: str, ranges: dict[str, tuple[int, int]]) -> dict[str, Column]:
    """One value in [low, high] per name, each from its own digits of a number column.

    The number is read in a mixed base, so the values are independent and cost a
    division each; the product of the range sizes must stay below 2**60.
    """
    picked, weight = {}, 1
    for name, (low, high) in ranges.items():
        size = high - low + 1
        picked[name] = F.expr(f"({number} div {weight}L) % {size}L + {low}L")
        weight *= size
    if weight >= 2 ** (4 * _HEX_DIGITS):
        raise ValueError("one number holds too few digits for these ranges")
    return picked


def hash_number(*keys: Column | str) -> Column:
    """A number in [0, 2**60) from the keys; NULL keys are left out."""
    return _digest_number(F.concat_ws("|", *[_as_text(k) for k in keys]))


def _measured(text: Column) -> Column:
    """A text behind its length, so that neighbours in a row of texts cannot run together."""
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def hash_id(*keys: Column | str) -> Column:
    """A stable surrogate id from the keys: all 128 bits of an md5 as text; NULL when any key is NULL."""
    return F.md5(F.concat(*[_measured(_as_text(key)) for key in keys]))


def row_id(scope: str, *columns: str) -> Column:
    """A 128-bit id of a row within a scope, never NULL; NULLs differ from empty texts."""
    parts = [F.coalesce(_measured(_as_text(c)), F.lit("~")) for c in columns]
    return F.md5(F.concat(F.lit(f"{scope};"), *parts))


def pick_int(low: int, high: int, *keys: Column | str) -> Column:
    """An integer in [low, high] chosen by the keys."""
    return F.lit(low).cast("bigint") + hash_number(*keys) % F.lit(high - low + 1)


def digits_id(digits: int, *keys: Column | str) -> Column:
    """A positive id with exactly ``digits`` decimal digits, chosen by the keys."""
    return pick_int(10 ** (digits - 1), 10**digits - 1, *keys)


def pick(options: Sequence[str], *keys: Column | str) -> Column:
    """One of ``options``, chosen by the keys."""
    return option_at(options, hash_number(*keys) % len(options))


def option_at(options: Sequence[str], place: Column) -> Column:
    """The option at a place counted from 0."""
    choices = F.array(*[F.lit(option) for option in options])
    return F.element_at(choices, (place + 1).cast("int"))


def chunk_of(chunks: Column | int, *keys: Column | str) -> Column:
    """A bucket number in [0, chunks), never NULL."""
    count = F.lit(chunks) if isinstance(chunks, int) else chunks
    return F.coalesce((hash_number(*keys) % count).cast("int"), F.lit(0))
