"""The month spine and the completeness of partitions against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_starts(first: Column, last: Column) -> Column:
    """Array of first-of-month dates from the month of ``first`` up to ``last``, both included."""
    return F.sequence(F.trunc(first, "MM"), last.cast("date"), F.expr("interval 1 month"))


def month_spine(bounds: DataFrame, first: str, last: str, name: str = "snapshot_date") -> DataFrame:
    """One row per month start for every row of ``bounds`` (usually one)."""
    return bounds.select(F.explode(month_starts(F.col(first), F.col(last))).alias(name))


def spine_between(spark, start: str, end: str, name: str = "snapshot_date") -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return month_spine(bounds, "first", "last", name)


def missing_partitions(expected: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """Expected (table, date) pairs without a partition: the warning list before a run."""
    return expected.join(present.select(*on).distinct(), on=on, how="left_anti")


def usable_partitions(expected: DataFrame, run_log: DataFrame, on: list[str]) -> DataFrame:
    """Expected pairs whose upstream partition was processed; the others are skipped."""
    good = run_log.filter(F.col("status") == "processed").select(*on).distinct()
    return expected.join(good, on=on, how="left_semi")
