"""Mean imputation with separate fit and apply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .schema import numeric_columns, quoted


def without_nan(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null; unchanged for types that have no NaN."""
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return F.when(~F.isnan(quoted(name)), quoted(name))
    return quoted(name)


def as_struct(stats: DataFrame) -> Column:
    """A one-row table as a scalar subquery: one value per run, no join and no fetch."""
    return stats.select(F.struct(*[quoted(c) for c in stats.columns])).scalar()


def fit_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the mean of every column; nulls and NaN do not count."""
    columns = numeric_columns(df) if columns is None else list(columns)
    return df.agg(*[F.avg(without_nan(df, c)).alias(c) for c in columns])


def impute_means(
    df: DataFrame, means: DataFrame, keep_type: bool = True, indicators: bool = False
) -> DataFrame:
    """Replace nulls and NaN by the fitted mean.

    With ``keep_type`` an integer column stays an integer and takes the whole part of the mean. With
    ``indicators`` every imputed column gets a 0/1 companion ``<name>_missing``.
    """
    columns = set(means.columns)
    with_means = df.withColumn("_means", as_struct(means))

    def filled(name):
        mean = F.col("_means").getField(name)
        if keep_type:
            mean = mean.cast(df.schema[name].dataType)
        return F.coalesce(without_nan(df, name), mean).alias(name)

    out = [filled(c) if c in columns else quoted(c) for c in df.columns]
    if indicators:
        out += [
            without_nan(df, c).isNull().cast("int").alias(f"{c}_missing") for c in df.columns if c in columns
        ]
    return with_means.select(*out)
