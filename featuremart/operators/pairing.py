"""Pair features with labels by key, and say how well they fit together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import quoted


def semi_join(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs among the members; duplicates there do not multiply rows."""
    return df.join(members.select(*on), on=list(on), how="left_semi")


def pairing_gate(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """One row: key counts on both sides, keys missing on one side, and whether the sides agree.

    Both sides are reduced to one row per key before they meet, so a repeated key costs nothing.
    """
    sides = (
        features.select(quoted(key), F.lit(1).alias("f"), F.lit(0).alias("l"))
        .unionAll(labels.select(quoted(key), F.lit(0).alias("f"), F.lit(1).alias("l")))
        .groupBy(key)
        .agg(F.sum("f").alias("f"), F.sum("l").alias("l"))
    )
    return sides.agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("feature_rows"),
        F.coalesce(F.sum("l"), F.lit(0)).alias("label_rows"),
        F.count_if(F.col("l") == 0).alias("features_without_label"),
        F.count_if(F.col("f") == 0).alias("labels_without_features"),
        (F.coalesce(F.sum("f"), F.lit(0)) == F.coalesce(F.sum("l"), F.lit(0))).alias("counts_match"),
    )


def pair_by_key(features: DataFrame, labels: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Features with the label of the same key. Never by row position."""
    return features.join(labels.select(quoted(key), quoted(label)), on=key, how="inner")
