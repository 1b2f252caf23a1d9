"""Loan lists: long counts, vocabulary, and one count column per token."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import token_counts, token_list
from .encoding import WIDEST
from .schema import quoted


def long_token_counts(df: DataFrame, column: str, ids: Sequence[str]) -> DataFrame:
    """(ids, token, n) per row; a row without tokens gives none. Nothing is shuffled."""
    return df.select(
        *[quoted(i) for i in ids], F.explode(token_counts(quoted(column))).alias("token", "n")
    )


def token_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct tokens of the whole table."""
    return df.select(F.explode(token_list(quoted(column))).alias("token")).distinct()


def fit_tokens(df: DataFrame, column: str, widest: int = WIDEST) -> list[str | None]:
    """The ``widest`` most frequent tokens in alphabetical order; when there are more, ``None`` stands at
    the end for all the others (:func:`long_token_counts` names every one)."""
    counts = df.select(F.explode(token_list(quoted(column))).alias("token")).groupBy("token").count()
    rows = counts.orderBy(F.desc("count"), "token").limit(widest + 1).collect()
    return sorted(r["token"] for r in rows[:widest]) + [None] * (len(rows) > widest)


def pivot_tokens(df: DataFrame, column: str, tokens: Sequence[str | None]) -> DataFrame:
    """One integer column per token, 0 where the row lacks it. ``None`` among them gives the column
    ``<column>__other`` that counts the tokens without a column. One vocabulary serves all partitions,
    so all of them get the same columns. Nothing is shuffled."""
    named, rest = [t for t in tokens if t is not None], f"{column}__other"
    names = [rest if t is None else t for t in tokens]
    clashes = [n for n in names if n in df.columns or names.count(n) > 1]
    if clashes:
        raise ValueError(f"tokens collide with columns: {clashes}")

    def total(t: str | None) -> Column:
        if t is not None:
            return F.try_element_at("_counts", F.lit(t))
        others = F.map_values(F.map_filter("_counts", lambda k, n: ~k.isin(named)))
        return F.aggregate(others, F.lit(0), lambda a, n: a + n.cast("int"))

    counted = df.withColumn("_counts", token_counts(quoted(column)))
    return counted.select(
        *[quoted(c) for c in df.columns],
        *[F.coalesce(total(t), F.lit(0)).alias(n) for t, n in zip(tokens, names, strict=True)],
    )
