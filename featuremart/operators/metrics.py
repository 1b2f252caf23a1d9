"""Classification metrics as tables, optionally per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as s
from ..sources.scratch import cut
from .quantiles import sketch
from .schema import quoted

GRID = s.ThresholdGrid()


def confusion_counts(actual: str, predicted: str) -> list[Column]:
    """The aggregates tn, fp, fn, tp."""
    a, p = F.col(actual), F.col(predicted)
    return [
        F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 1) & (p == 1)).alias("tp"),
    ]


def confusion(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp in one pass; one row per group, one row in all without keys."""
    return df.groupBy(*keys).agg(*confusion_counts(actual, predicted))


def with_rates(counts: DataFrame, beta: float = 1.5) -> DataFrame:
    """Precision, recall, F1 and F-beta from confusion counts; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": s.precision(tp, fp),
            "recall": s.recall(tp, fn),
            "f1_score": s.f_beta(tp, fp, fn),
            "f15_score": s.f_beta(tp, fp, fn, beta),
        }
    )


#: Edges that are looked at one after the other to find a score's bucket.
STRIDE = 32


def bucketed_scores(counts: DataFrame, keys: Sequence[str] = (), buckets: int = 1024) -> DataFrame:
    """``counts`` with ``_bucket``: the place of the score ``_s`` among the quantiles of its own group's
    distinct scores, so that every group, whatever band it lies in, is cut into buckets of equal size."""
    inner = [i / buckets for i in range(1, buckets)]
    edges = counts.groupBy(*[quoted(k) for k in keys]).agg(sketch("_s", inner, 10 * buckets).alias("_edges"))
    marks = F.expr(f"transform(sequence(1, size(_edges) div {STRIDE}), j -> _edges[j * {STRIDE} - 1])")
    edges = edges.withColumn("_marks", F.expr("array()").cast("array<double>") if buckets <= STRIDE else marks)
    if keys:
        named = edges.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)})
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & counts[f"`{k}`"].eqNullSafe(named[f"_key{i}"])
        found = counts.join(named, same)
    else:
        found = counts.withColumn("_e", edges.select(F.struct("_edges", "_marks")).scalar()).select("*", "_e.*")
    coarse = f"{STRIDE} * size(filter(_marks, e -> e < _s))"
    fine = F.expr(f"size(filter(slice(_edges, _at + 1, {STRIDE - 1}), e -> e < _s))")
    placed = found.withColumn("_at", F.expr(coarse)).withColumn("_bucket", F.col("_at") + fine)
    return placed.select(*[quoted(c) for c in counts.columns], "_bucket")


def roc_auc(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = (), buckets: int = 1024
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is absent.

    Rows with equal scores are counted first, in the one pass over the rows, so a popular score is one
    row. Quantiles of each group's scores cut its range into buckets of about equal size. Pairs inside a
    bucket come from a running count in that bucket; pairs across buckets from a running count over the
    few buckets. The counts are written when this is called; the rest runs with the result.
    """
    keep = [quoted(k) for k in keys]
    rows = df.select(*keep, quoted(score).cast("double").alias("_s"), quoted(label).alias("_y")).filter(
        "_s IS NOT NULL AND _y IS NOT NULL"
    )
    counts = rows.groupBy(*keep, "_s").agg(
        F.count_if(F.col("_y") == 1).cast("double").alias("_pos"),
        F.count_if(F.col("_y") == 0).cast("double").alias("_neg"),
    )
    counts = bucketed_scores(cut(counts, "score-counts"), keys, buckets)
    lower = Window.partitionBy(*keep, "_bucket").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (
        counts.withColumn("_below", F.coalesce(F.sum("_neg").over(lower), F.lit(0.0)))
        .groupBy(*keep, "_bucket")
        .agg(
            F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)).alias("_inside"),
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
        )
    )
    earlier = Window.partitionBy(*keep).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("_inside") + F.col("_pos") * F.coalesce(F.sum("_neg").over(earlier), F.lit(0.0))
    return (
        per_bucket.withColumn("_won", won)
        .groupBy(*keep)
        .agg(F.try_divide(F.sum("_won"), F.sum("_pos") * F.sum("_neg")).alias("auc"))
    )


def threshold_curve(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = (), grid: s.ThresholdGrid = GRID
) -> DataFrame:
    """Confusion counts and F1 at every grid threshold.

    Rows collapse to one count per number of thresholds passed (at most ``grid.size + 1`` per group);
    only those few rows are spread over the thresholds.
    """
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    passed = (
        rows.groupBy(*keys, grid.count_below(F.col(score)).alias("_passed"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
        .withColumn("index", F.explode(F.sequence(F.lit(0), F.lit(grid.size - 1))))
    )
    above = F.col("_passed") > F.col("index")
    counts = passed.groupBy(*keys, "index").agg(
        F.sum(F.when(above, F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("_neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(above, 0).otherwise(F.col("_pos"))).alias("fn"),
        F.sum(F.when(above, 0).otherwise(F.col("_neg"))).alias("tn"),
    )
    return counts.withColumns(
        {
            "threshold": grid.value(F.col("index")),
            "f1_score": s.f_beta(F.col("tp"), F.col("fp"), F.col("fn")),
        }
    )


def best_threshold(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The threshold with the highest F1; the lowest one among equals."""
    return curve.groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "f1_score"), F.struct("f1_score", -F.col("index"))).alias("_best")
    ).select(*keys, "_best.threshold", "_best.f1_score")


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Rows collapse to one count per (actual, predicted) pair before anything else. The accuracy row
    has the accuracy in ``f1_score`` and null in the other two rates.
    """
    pairs = (
        df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called")),
            )
        ).alias("x"),
        F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
    )
    # Each hit is seen from both sides.
    classes = (
        sides.groupBy(F.col("x.c").alias("c"))
        .agg(F.sum("x.support").alias("support"), F.sum("x.called").alias("called"), (F.sum("hit") / 2).cast("long").alias("tp"))
        .select(
            F.col("c").cast("string").alias("class"),
            s.precision(F.col("tp"), F.col("called") - F.col("tp")).alias("precision"),
            s.recall(F.col("tp"), F.col("support") - F.col("tp")).alias("recall"),
            s.f_beta(F.col("tp"), F.col("called") - F.col("tp"), F.col("support") - F.col("tp")).alias("f1_score"),
            "support",
            "tp",
        )
    )
    rates = ("precision", "recall", "f1_score")
    total = F.sum("support")
    overall = classes.agg(
        *[F.avg(r).alias(f"macro_{r}") for r in rates],
        *[F.try_divide(F.sum(F.col(r) * F.col("support")), total).alias(f"weighted_{r}") for r in rates],
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        total.alias("support"),
    )
    null = F.lit(None).cast("double")
    averages = overall.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    null.alias("precision"),
                    null.alias("recall"),
                    F.col("accuracy").alias("f1_score"),
                    "support",
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"),
                        *[F.col(f"{kind}_{r}").alias(r) for r in rates],
                        "support",
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        ).alias("x")
    ).select("x.*")
    return classes.drop("tp").unionByName(averages)
