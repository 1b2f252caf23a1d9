"""Clip columns at a quantile of their own partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantile
from .schema import quoted


def fit_caps(
    df: DataFrame,
    columns: Sequence[str],
    q: float = 0.97,
    by: str = "snapshot_date",
    relative_error: float = 0.01,
    exact: bool = False,
) -> DataFrame:
    """One row per partition with the cap of every column, from one aggregate over all of them.

    The default is a sketch within ``relative_error`` of the rank; ``exact`` finds the true quantile.
    A column without values in a partition has a null cap.
    """
    if exact:
        return exact_quantile(df, columns, q, keys=[by])
    accuracy = max(1, round(1 / relative_error))
    return df.groupBy(by).agg(
        *[F.percentile_approx(quoted(c).cast("double"), F.lit(q), F.lit(accuracy)).alias(c) for c in columns]
    )


def clip_above(df: DataFrame, caps: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """Values above their partition's cap become the cap; nulls stay null, a null cap clips nothing.

    The clipped columns are doubles, as the cap is. ``caps`` has one row per partition;
    adaptive execution broadcasts it if its measured size allows.
    """
    renamed = caps.select(
        quoted(by).alias("_by"), *[quoted(c).alias(f"_cap_{c}") for c in columns]
    )
    joined = df.join(renamed, df[by] == renamed["_by"], "left")

    def clipped(c):
        value, cap = quoted(c).cast("double"), quoted(f"_cap_{c}")
        return F.when(value > cap, cap).otherwise(value).alias(c)

    return joined.select(*[clipped(c) if c in columns else quoted(c) for c in df.columns])
