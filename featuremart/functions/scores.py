"""Expressions over confusion counts, scores and the threshold grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return _ratio_or_zero(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return _ratio_or_zero(tp, tp + fn)


def f_beta(tp: Column, fp: Column, fn: Column, beta: float = 1.0) -> Column:
    """F-beta from counts; 0 when there are no positives of any kind."""
    b2 = float(beta) ** 2
    return _ratio_or_zero(tp * (1.0 + b2), tp * (1.0 + b2) + fn * b2 + fp)


def predicted_class(score: Column, threshold) -> Column:
    """1 when the score lies strictly above the threshold, else 0; null score gives null."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score > t).cast("int")


@dataclass(frozen=True)
class ThresholdGrid:
    """Evenly spaced thresholds start, start + step, ... below stop.

    Each value is start + i * ((start + step) - start) in double arithmetic, so the values are the
    ones numpy's ``arange`` gives, last bits included.
    """

    start: float = 0.1
    stop: float = 0.9
    step: float = 0.01

    @property
    def delta(self) -> float:
        return (self.start + self.step) - self.start

    @property
    def size(self) -> int:
        ratio = (self.stop - self.start) / self.step
        return int(-(-ratio // 1))

    def value(self, index: Column) -> Column:
        return F.lit(self.start) + index * F.lit(self.delta)

    def values(self) -> list[float]:
        return [self.start + i * self.delta for i in range(self.size)]

    def count_below(self, score: Column) -> Column:
        """How many grid thresholds lie strictly below the score.

        The index is estimated by division, taken one step lower, and the three thresholds next to
        it are compared exactly, so rounding in the division cannot shift the count.
        """
        ratio = (score - F.lit(self.start)) / F.lit(self.delta)
        clamped = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(float(self.size)))
        base = F.greatest(F.floor(clamped).cast("int") - 1, F.lit(0))
        passed = base
        for k in range(3):
            index = base + k
            passed = passed + F.when((index < self.size) & (score > self.value(index)), 1).otherwise(0)
        return passed
