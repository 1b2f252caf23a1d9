"""Score distribution, missing values and extreme scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import linear_percentiles, sketch
from .schema import quoted

# The percentiles and the score bounds a report looks at.
PERCENTS = (10, 25, 50, 75, 90)
VERY_LOW, VERY_HIGH = 0.01, 0.99


def total_counts(score: str, predicted: str) -> list[Column]:
    """The aggregates: row count, positives, positive rate, mean score, extreme scores."""
    return [
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(F.sum(F.col(predicted).cast("long")), F.lit(0)).alias("positive_predictions"),
        F.avg(predicted).alias("positive_rate"),
        F.avg(score).alias("avg_prediction_proba"),
        F.count_if(F.col(score) < VERY_LOW).alias("very_low"),
        F.count_if(F.col(score) > VERY_HIGH).alias("very_high"),
    ]


def score_totals(df: DataFrame, score: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*total_counts(score, predicted))


def score_percentiles(
    df: DataFrame, score: str, keys: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """p10 .. p90 of the score: exact with linear interpolation, or from one sketch."""
    if not approximate:
        return linear_percentiles(df, score, PERCENTS, keys)
    return (
        df.groupBy(*keys)
        .agg(sketch(score, [p / 100 for p in PERCENTS], 10_000).alias("_p"))
        .select(*keys, *[F.get("_p", F.lit(i)).alias(f"p{p}") for i, p in enumerate(PERCENTS)])
    )


def missing_array(columns: Sequence[str]) -> Column:
    """Aggregate: array of (column, missing) for the columns that have nulls."""
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(quoted(c).isNull()).alias("missing")) for c in columns]
    return F.filter(F.array(*counts), lambda x: x["missing"] > 0)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) for the columns that have nulls; one pass over the table."""
    counted = df.agg(missing_array(df.columns if columns is None else columns).alias("x"))
    return counted.select(F.inline("x"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"))
