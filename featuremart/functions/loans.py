"""Expressions for loan performance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def installments_missed(overdue: Column, due: Column) -> Column:
    """Whole instalments the overdue amount stands for; 0 when it cannot be told (due is 0)."""
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days since the first missed instalment; 0 when nothing is overdue.

    An overdue amount with no due amount has no first missed date, so the days are null.
    """
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def past_due_label(dpd: Column, days: int) -> Column:
    """1 when at least ``days`` past due, else 0; unknown days count as 0."""
    return F.when(dpd >= days, 1).otherwise(0).cast("int")


def label_definition(days: int, mob: int) -> Column:
    return F.lit(f"{days}dpd_{mob}mob")
