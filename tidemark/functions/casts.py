"""Casts that turn unreadable text into NULL instead of failing the job under ANSI.

A failing ``try_cast`` raises and catches an exception for every bad value, which is some
fifty times the cost of a good one. Where bad values are to be expected in bulk, a cheap
look at the text decides first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip_whitespace

_DIRECT_TO_LONG = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# --- fixed values: the words that a cast from text to boolean accepts ----------------
TRUE_WORDS = ["t", "true", "y", "yes", "1"]
FALSE_WORDS = ["f", "false", "n", "no", "0"]


def to_number(c: Column) -> Column:
    """Exact decimal reading of a text column, NULL where it is not a number."""
    return F.when(c.rlike(r"^\s*[+-]?\.?\d"), c.try_cast("decimal(38,6)"))


def to_long(c: Column, dtype: T.DataType | None = None) -> Column:
    """BIGINT reading: fractions are truncated ('12.7' -> 12), junk gives NULL.

    Plain integers are read directly. What is left goes through DECIMAL, which keeps
    large values exact, as DOUBLE would not.
    """
    if isinstance(dtype, _DIRECT_TO_LONG):
        return c.cast("bigint")
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.try_cast("bigint")
    return F.when(c.rlike(r"^[+-]?\d{1,18}$"), c.try_cast("bigint")).otherwise(
        to_number(c).try_cast("bigint")
    )


def to_flag(c: Column, dtype: T.DataType | None = None) -> Column:
    """BOOLEAN reading with the vocabulary of a cast (true/t/yes/y/1 and opposites)."""
    if isinstance(dtype, T.BooleanType):
        return c
    word = F.lower(strip_whitespace(c.cast("string")))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(
        word.isin(FALSE_WORDS), F.lit(False)
    )


def text_flag(c: Column) -> Column:
    """Strict reading: only 'true' and 'false', in any letter case."""
    low = F.lower(c)
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("bigint"))
