"""Category vocabularies and one-hot columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .schema import quoted

#: Categories or tokens with a column of their own in the wide forms; the rest share one.
WIDEST = 1_000


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, category, n) for all the columns in one aggregate; nulls are no category."""
    melted = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("category"))
                    for c in columns
                ]
            )
        ).alias("p")
    ).select("p.column", "p.category")
    return (
        melted.filter(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero-based index of each category: most frequent first, ties in alphabetical order.

    The categories of a column, not its rows, are ordered in one task.
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("category"))
    return category_counts(df, columns).withColumn("index", F.row_number().over(order) - 1)


def fit_categories(
    df: DataFrame, columns: Sequence[str], widest: int = WIDEST
) -> dict[str, list[str | None]]:
    """Categories per column in index order.

    They become columns, so a column names its ``widest`` most frequent categories; when there are
    more, ``None`` stands at the end for all the others. :func:`category_counts` names every one.
    """
    # Spark keeps the first ranks of each task before it shuffles.
    rows = category_index(df, columns).filter(F.col("index") <= widest).collect()
    found: dict[str, list[str | None]] = {c: [] for c in columns}
    for row in sorted(rows, key=lambda r: r["index"]):
        found[row["column"]].append(row["category"] if row["index"] < widest else None)
    return found


def one_hot(df: DataFrame, vocabularies: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """Replace each column by 0/1 columns ``<column>_<category in lower case>``, and for ``None`` in its
    vocabulary by ``<column>__other``, which marks every value without a column of its own.

    Null gives zeros everywhere, and so do unseen values of a vocabulary without ``None``.
    """

    def name(column: str, value: str | None) -> str:
        return f"{column}__other" if value is None else f"{column}_{value.lower()}"

    def flag(column: str, value: str | None) -> Column:
        if value is not None:
            return quoted(column) == F.lit(value)
        return ~quoted(column).isin([v for v in vocabularies[column] if v is not None])

    names = Counter(name(c, v) for c, values in vocabularies.items() for v in values)
    clashes = [n for n, k in names.items() if k > 1 or n in df.columns]
    if clashes:
        raise ValueError(f"one-hot column names collide: {clashes}")
    kept = [quoted(c) for c in df.columns if c not in vocabularies]
    flags = [
        F.coalesce(flag(c, v).cast("int"), F.lit(0)).alias(name(c, v))
        for c, values in vocabularies.items()
        for v in values
    ]
    return df.select(*kept, *flags)
