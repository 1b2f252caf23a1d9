"""Expressions that turn dirty text into typed, validated values.

Bad text becomes null and never fails the job: every conversion is a ``try_cast``, which holds
whether or not ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and markers found in the source data.
NUMBER_PATTERN = r"([-+]?\d*\.?\d+)"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
EMPTY_OCCUPATION = "_______"
EMPTY_CREDIT_MIX = "_"
AGE_RANGE = (0, 120)


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_number(c: Column) -> Column:
    """Text of the first number in ``c``; null when there is none."""
    return null_if_empty(F.regexp_extract(c.cast("string"), NUMBER_PATTERN, 1))


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_int(c: Column) -> Column:
    """Whole part of a number in text: '12.5' gives 12, out of range gives null."""
    return c.try_cast("double").try_cast("int")


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def within(c: Column, low, high) -> Column:
    """``c`` where low <= c <= high, else null."""
    return F.when(c.between(low, high), c)


def non_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def matching(c: Column, pattern: str) -> Column:
    """``c`` where the pattern matches, else null."""
    return F.when(c.rlike(pattern), c)


def without(c: Column, sentinel: str) -> Column:
    """``c`` with the sentinel value turned into null."""
    return F.nullif(c, F.lit(sentinel))
