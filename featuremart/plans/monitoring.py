"""Monitoring of scored rows: distribution, metrics, drift, data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.boosting import SCORE
from ..operators.imputation import as_struct
from ..operators.metrics import confusion_counts, roc_auc, with_rates
from ..operators.profiling import missing_array, score_percentiles, total_counts

# Fixed value: an AUC further than this from the baseline is an alert.
AUC_TOLERANCE = 0.05


def drift_message(auc: Column, baseline: Column, tolerance: float = AUC_TOLERANCE) -> Column:
    """Alert text when the AUC moved by more than the tolerance, else null."""
    drift = F.abs(auc - baseline)
    return F.when(drift > tolerance, F.concat(F.lit("HIGH AUC DRIFT: "), F.format_string("%.4f", drift)))


def drift_by_run(metrics: DataFrame, baseline: DataFrame, tolerance: float = AUC_TOLERANCE) -> DataFrame:
    """Drift of each run's AUC against one baseline row with a column ``auc``."""
    return metrics.withColumn("baseline_auc", baseline.select("auc").scalar()).withColumns(
        {
            "auc_drift": F.abs(F.col("auc") - F.col("baseline_auc")),
            "drift_alert": drift_message(F.col("auc"), F.col("baseline_auc"), tolerance),
        }
    )


METRICS = "kind string, run_id string, model_run_id string, auc double"


def store_metrics(rows: DataFrame, path: str) -> None:
    """Keep metrics of runs (:data:`METRICS`; kind 'training' or 'monitoring'). Those of a run that is
    stored again replace its earlier ones; other runs stay."""
    writer = rows.select("kind", "run_id", "model_run_id", "auc").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("kind", "run_id").parquet(path)


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)


def drift_history(metrics: DataFrame, tolerance: float = AUC_TOLERANCE) -> DataFrame:
    """Each stored monitoring run against the training run of the model it scored with; without one the
    baseline is null and nothing is judged."""
    base = metrics.filter("kind = 'training'").select(F.col("run_id").alias("model_run_id"), F.col("auc").alias("baseline_auc"))
    runs = metrics.filter("kind = 'monitoring'").join(base, "model_run_id", "left")
    auc, baseline = F.col("auc"), F.col("baseline_auc")
    return runs.select(
        "run_id",
        "model_run_id",
        "auc",
        "baseline_auc",
        F.abs(auc - baseline).alias("auc_drift"),
        drift_message(auc, baseline, tolerance).alias("drift_alert"),
    )


def has_quality_issues(missing_columns: Column, very_low: Column, very_high: Column) -> Column:
    """True when a column has missing values or a score is extreme."""
    return (missing_columns > 0) | (very_low + very_high > 0)


def monitoring_report(
    predictions: DataFrame,
    baseline_auc: float | Column | None = None,
    tolerance: float = AUC_TOLERANCE,
    approximate_percentiles: bool = False,
    timestamp: str | None = None,
) -> DataFrame:
    """One nested row about the predictions of one run.

    ``baseline_auc`` is what the current AUC is compared with, for example the AUC on the test split
    when the model was trained; without it drift is not judged. All counts come from one aggregate;
    the percentiles and the AUC need an order and come in as scalar subqueries.
    """
    has_labels = "actual_label" in predictions.columns
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if timestamp is None else F.lit(timestamp)
    counted = predictions.agg(
        F.min("model_run_id").alias("run_id"),
        F.min("threshold_used").alias("threshold_used"),
        *total_counts(SCORE, "prediction_binary"),
        F.map_from_entries(missing_array(predictions.columns)).alias("missing"),
        *(confusion_counts("actual_label", "prediction_binary") if has_labels else []),
    )
    percentiles = score_percentiles(predictions, SCORE, approximate=approximate_percentiles)
    report = counted.select(
        "run_id",
        now.alias("monitoring_timestamp"),
        "total_predictions",
        "positive_predictions",
        "positive_rate",
        "avg_prediction_proba",
        "threshold_used",
        as_struct(percentiles).alias("prob_percentiles"),
        F.lit(has_labels).alias("has_performance_metrics"),
        F.struct(
            F.col("missing").alias("missing_values"),
            F.struct("very_low", "very_high").alias("extreme_probabilities"),
        ).alias("data_quality"),
        has_quality_issues(F.size("missing"), F.col("very_low"), F.col("very_high")).alias("data_quality_issues"),
        *(("tn", "fp", "fn", "tp") if has_labels else ()),
    )
    if not has_labels:
        return report.withColumn("drift_alerts", F.array().cast("array<string>"))
    if baseline_auc is None:
        alert = F.lit(None).cast("string")
    else:
        base = baseline_auc if isinstance(baseline_auc, Column) else F.lit(float(baseline_auc))
        alert = drift_message(F.col("auc_score"), base, tolerance)
    return (
        with_rates(report)
        .withColumns(
            {
                "auc_score": roc_auc(predictions, SCORE, "actual_label").scalar(),
                "confusion_matrix": F.struct("tn", "fp", "fn", "tp"),
            }
        )
        .withColumn("drift_alerts", F.array_compact(F.array(alert)))
        .drop("tn", "fp", "fn", "tp")
    )


def write_report(report: DataFrame, path: str) -> None:
    """A report is one row, so it goes to one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
