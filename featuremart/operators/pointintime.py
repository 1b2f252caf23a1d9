"""Averages of facts known up to an anchor date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .schema import quoted


def point_in_time_means(
    facts: DataFrame,
    anchors: DataFrame,
    key: str,
    fact_date: str,
    anchor_date: str,
    columns: Sequence[str],
    prefix: str = "avg_",
    anchor: str = "all",
) -> DataFrame:
    """Mean of each column over the facts dated on or before an anchor of the same key.

    A fact counts once for every anchor at or after it (``anchor='all'``, what an inner join of
    facts and anchors gives), or once if it is not after the first anchor (``anchor='min'``). Keys
    without an anchor, or without a fact before one, have no row.

    No fact is paired with an anchor. Facts are first summed per (key, day) and anchors counted per
    (key, day), so a key with a huge number of rows leaves the map side as one row per day. A running
    total of the anchors over the days, latest first, is then the number of anchors a day counts for.
    """
    if anchor not in ("all", "min"):
        raise ValueError("anchor must be 'all' or 'min'")
    day = F.col(fact_date).cast("date")
    daily = (
        facts.select(quoted(key), day.alias("_day"), *[quoted(c) for c in columns])
        .filter(F.col(key).isNotNull() & F.col("_day").isNotNull())
        .groupBy(key, "_day")
        .agg(
            *[F.sum(quoted(c).cast("double")).alias(f"_sum_{c}") for c in columns],
            *[F.count(quoted(c)).alias(f"_count_{c}") for c in columns],
        )
    )
    marks = anchors.select(quoted(key), F.col(anchor_date).cast("date").alias("_day")).filter(
        F.col(key).isNotNull() & F.col("_day").isNotNull()
    )
    if anchor == "min":
        weights = marks.groupBy(key).agg(F.min("_day").alias("_day")).withColumn("_anchors", F.lit(1))
    else:
        weights = marks.groupBy(key, "_day").agg(F.count(F.lit(1)).alias("_anchors"))
    both = daily.withColumn("_fact", F.lit(True)).unionByName(weights, allowMissingColumns=True)
    # The default frame includes all rows of the same day, so an anchor counts facts of its own day.
    latest_first = Window.partitionBy(key).orderBy(F.desc("_day"))
    weighted = both.withColumn("_weight", F.sum("_anchors").over(latest_first)).filter(
        F.col("_fact") & (F.col("_weight") > 0)
    )
    return weighted.groupBy(key).agg(
        *[
            F.try_divide(
                F.sum(F.col("_weight") * quoted(f"_sum_{c}")), F.sum(F.col("_weight") * quoted(f"_count_{c}"))
            ).alias(f"{prefix}{c}")
            for c in columns
        ]
    )
