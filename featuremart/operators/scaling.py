"""Standardisation fitted on chosen rows and applied to any rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .imputation import as_struct, without_nan
from .schema import quoted


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct (mean, scale) per column: population deviation, 1 where it is 0."""
    return df.agg(
        *[
            F.struct(
                F.avg(without_nan(df, c).cast("double")).alias("mean"),
                F.coalesce(F.nullif(F.stddev_pop(without_nan(df, c).cast("double")), F.lit(0.0)), F.lit(1.0)).alias(
                    "scale"
                ),
            ).alias(c)
            for c in columns
        ]
    )


def scale(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """(value - mean) / scale for the fitted columns; nulls stay null, other columns pass through."""
    fitted = set(scaler.columns)

    def scaled(c):
        stats = F.col("_scaler").getField(c)
        return ((quoted(c).cast("double") - stats.getField("mean")) / stats.getField("scale")).alias(c)

    return df.withColumn("_scaler", as_struct(scaler)).select(
        *[scaled(c) if c in fitted else quoted(c) for c in df.columns]
    )
