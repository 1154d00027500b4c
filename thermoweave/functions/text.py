"""String expressions with the semantics of the JVM's string class."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT32 = (1 << 32) - 1
INT31 = 1 << 31


def split_words(text: Column, sep: str) -> Column:
    """Split on a literal separator; trailing empty parts go, leading and inner ones stay.

    The empty string gives one empty part; a string of separators only gives none; null
    gives null.
    """
    quoted = re.escape(sep)
    if len(sep) == 1:
        stripped = F.rtrim(text, F.lit(sep))
    else:
        stripped = F.regexp_replace(text, f"(?:{quoted})+\\z", "")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, quoted, -1))
    )


def split_lines(text: Column) -> Column:
    """The lines a line reader yields: a final line break does not open another line."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(text, r"\r?\n\z", ""), r"\r?\n", -1)
    )


def wrap_int(value: Column) -> Column:
    """Keep the low 32 bits of a BIGINT as a signed INT (ANSI casts raise instead)."""
    low = value.cast("bigint").bitwiseAND(F.lit(UINT32))
    return F.when(low >= INT31, low - F.lit(UINT32 + 1)).otherwise(low).cast("int")


# Fold of h*31 + unit over UTF-16 units, modulo 2**32; larger code points are two units.
_HASH_SQL = """
aggregate(
  transform(split({s}, ''), c -> CAST(ascii(c) AS BIGINT)), 0L,
  (h, c) -> CASE WHEN c <= 65535 THEN (h * 31 + c) & 4294967295L
    ELSE (((h * 31 + 55296 + shiftright(c - 65536, 10)) & 4294967295L) * 31
          + 56320 + ((c - 65536) & 1023)) & 4294967295L END)
"""


def _hash_sql(arg: str, factor: int) -> str:
    product = f"({_HASH_SQL.format(s=arg)}) * {factor}L"
    return (
        f"CAST((({product} + 2147483648L) & 4294967295L) - 2147483648L AS INT)"
    )


def string_hash(column: str, factor: int = 1) -> Column:
    """The JVM string hash of a column times ``factor``, wrapped to a signed INT."""
    return F.expr(_hash_sql(f"`{column}`", factor))
