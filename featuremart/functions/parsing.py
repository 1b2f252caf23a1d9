"""Expressions that split structured text: durations, spending codes, loan lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import null_if_empty, to_int

# Fixed value: the spending code, two parts.
SPENDING_PATTERN = r"(Low|High)_spent_(Small|Medium|Large)_value"

WHITESPACE = " \t\n\r\f\x0b"


def duration_part(c: Column, unit: str) -> Column:
    """The count before ``unit`` in text such as '10 Years and 9 Months'; null when absent."""
    return to_int(null_if_empty(F.regexp_extract(c, rf"(\d+)\s+{unit}", 1)))


def total_months(years: Column, months: Column) -> Column:
    return years * 12 + months


def code_part(c: Column, part: int, pattern: str = SPENDING_PATTERN) -> Column:
    return null_if_empty(F.regexp_extract(c, pattern, part))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def token_list(c: Column) -> Column:
    """Tokens of a list such as 'Auto Loan, Not Specified, and Auto Loan', in order.

    Tokens are trimmed and lowercased, inner blanks become underscores, empty ones are left out.
    Null text has no tokens.
    """
    pieces = F.split(F.replace(c, F.lit(" and "), F.lit(",")), ",")
    tokens = F.transform(
        pieces, lambda p: F.lower(F.replace(F.btrim(p, F.lit(WHITESPACE)), F.lit(" "), F.lit("_")))
    )
    return F.coalesce(F.filter(tokens, lambda t: t != ""), F.array().cast("array<string>"))


def token_counts(c: Column) -> Column:
    """Map from token to how often it occurs in the list."""

    def count_each(tokens: Column) -> Column:
        distinct = F.array_distinct(tokens)
        return F.map_from_arrays(
            distinct, F.transform(distinct, lambda d: F.size(F.filter(tokens, lambda t: t == d)))
        )

    return _let(token_list(c), count_each)
