"""Run log per (layer, table, partition), run summary and issue rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.imputation import as_struct
from ..operators.profiling import table_shape
from ..sources.tables import SNAPSHOT

LOG_COLUMNS = ("layer", "table_name", SNAPSHOT, "rows", "status", "error")


def partition_log(expected: DataFrame, counts: DataFrame, layer: str, reasons: DataFrame | None = None) -> DataFrame:
    """One row per expected (table_name, snapshot_date): rows written, status, error.

    One distributed job has no try/except per partition, so the status comes from the data: an
    expected partition without rows, or one that ``reasons`` (table_name, snapshot_date, reason) names, is
    recorded as failed and the rest goes on.
    """
    on = ["table_name", SNAPSHOT]
    joined = expected.select(*on).join(counts.select(*on, "rows"), on=on, how="left")
    if reasons is None:
        joined = joined.withColumn("reason", F.lit(None).cast("string"))
    else:
        joined = joined.join(reasons.groupBy(*on).agg(F.min("reason").alias("reason")), on=on, how="left")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    nothing = F.concat(F.lit("no rows in "), F.col("table_name"), F.lit(" for "), F.col(SNAPSHOT).cast("string"))
    return joined.select(
        F.lit(layer).alias("layer"),
        *on,
        rows.alias("rows"),
        F.when((rows > 0) & F.col("reason").isNull(), "processed").otherwise("failed").alias("status"),
        F.coalesce("reason", F.when(rows == 0, nothing)).alias("error"),
    )


def append_log(log: DataFrame, path: str, run_id: str, attempt: int) -> None:
    """Add one attempt's log to the table of all attempts; nothing there is changed."""
    rows = log.select(F.lit(run_id).alias("run_id"), F.lit(attempt).cast("int").alias("attempt"), *LOG_COLUMNS)
    rows.write.mode("append").parquet(path)


def latest_status(history: DataFrame) -> DataFrame:
    """Of each (layer, table, partition) the log row of its last attempt, whichever run that was."""
    key = ["layer", "table_name", SNAPSHOT]
    rest = [c for c in history.columns if c not in key]
    last = history.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("attempt", "run_id")).alias("_last"))
    return last.select(*key, *[f"_last.{c}" for c in rest])


def pending(expected: DataFrame, history: DataFrame, layer: str) -> DataFrame:
    """Expected (table_name, snapshot_date) pairs whose last attempt failed, or that had none."""
    on = ["table_name", SNAPSHOT]
    done = latest_status(history.filter(F.col("layer") == layer)).filter(F.col("status") == "processed")
    return expected.select(*on).join(done.select(*on), on=on, how="left_anti")


def table_log(log: DataFrame) -> DataFrame:
    """Partitions processed and failed per (layer, table)."""
    return log.groupBy("layer", "table_name").agg(
        F.count_if(F.col("status") == "processed").alias("partitions_processed"),
        F.count_if(F.col("status") == "failed").alias("partitions_failed"),
        F.sum("rows").alias("rows"),
    )


def layer_log(log: DataFrame) -> DataFrame:
    """Tables with at least one good partition, partitions processed, and errors, per layer."""
    return (
        table_log(log)
        .groupBy("layer")
        .agg(
            F.count_if(F.col("partitions_processed") > 0).alias("tables_processed"),
            F.sum("partitions_processed").alias("total_partitions"),
            F.sum("partitions_failed").alias("errors"),
        )
    )


def layer_numbers(log: DataFrame, layer: str) -> DataFrame:
    """One row for one layer, with zeros when the layer has no log."""
    return (
        layer_log(log)
        .filter(F.col("layer") == layer)
        .agg(
            *[
                F.coalesce(F.sum(c), F.lit(0)).alias(c)
                for c in ("tables_processed", "total_partitions", "errors")
            ]
        )
    )


def issue_messages(
    bronze_partitions: Column,
    silver_partitions: Column,
    feature_rows: Column,
    model_saved: Column,
    predictions_made: Column,
    total_predictions: Column,
    monitored: Column,
    quality_issues: Column,
    drift_alerts: Column,
    errors: Mapping[str, Column] | None = None,
) -> Column:
    """Array of the messages whose rule holds.

    ``errors`` adds one message per layer with failed partitions, so that a run on left-over
    partitions does not pass unnoticed.
    """
    # The messages.
    rules = [
        (bronze_partitions == 0, F.lit("No bronze tables processed successfully")),
        (silver_partitions == 0, F.lit("No silver tables processed successfully")),
        (feature_rows == 0, F.lit("No feature data generated")),
        (~model_saved, F.lit("Model training failed")),
        (~predictions_made, F.lit("Prediction generation failed")),
        (predictions_made & (total_predictions == 0), F.lit("No predictions generated")),
        (~monitored, F.lit("Model monitoring failed")),
        (monitored & quality_issues, F.lit("Data quality issues detected")),
        (drift_alerts > 0, F.concat(drift_alerts.cast("string"), F.lit(" model drift alerts"))),
    ]
    for layer, failed in (errors or {}).items():
        rules.append((failed > 0, F.concat(failed.cast("string"), F.lit(f" {layer} partitions failed"))))
    return F.array_compact(F.array(*[F.when(rule, message) for rule, message in rules]))


def overall_status(issues: Column) -> Column:
    return F.when(F.size(issues) > 0, "completed_with_issues").otherwise("completed_successfully")


def run_summary(
    spark: SparkSession,
    log: DataFrame,
    features: DataFrame,
    labels: DataFrame,
    run_id: str | None = None,
    model_path: str | None = None,
    evaluation: DataFrame | None = None,
    report: DataFrame | None = None,
    storage_method: str = "spark_ml",
    report_errors: bool = True,
    timestamp: str | None = None,
    failures: Sequence[str] = (),
    gold_status: str = "completed",
) -> DataFrame:
    """One nested row about a whole run; sections of steps that did not run hold defaults. ``failures``
    are messages of failed steps; they join the issues."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if timestamp is None else F.lit(timestamp)
    nulls = lambda kind: F.lit(None).cast(kind)
    base = spark.range(1).select(
        as_struct(layer_numbers(log, "bronze")).alias("bronze"),
        as_struct(layer_numbers(log, "silver")).alias("silver"),
        as_struct(table_shape(features)).alias("f"),
        as_struct(table_shape(labels)).alias("l"),
        (as_struct(report) if report is not None else nulls("string")).alias("r"),
        (as_struct(evaluation) if evaluation is not None else nulls("struct<oot_f1:double,oot_f15:double,oot_auc:double>")).alias("e"),
    )
    has_report, saved = F.lit(report is not None), F.lit(model_path is not None)

    def of_report(name, default):
        return F.coalesce(F.col(f"r.{name}"), default) if report is not None else default

    total = of_report("total_predictions", F.lit(0).cast("long"))
    quality = of_report("data_quality_issues", F.lit(True))
    alerts = F.size("r.drift_alerts") if report is not None else F.lit(0)
    performance = report is not None and "f1_score" in report.columns
    issues = issue_messages(
        F.col("bronze.total_partitions"),
        F.col("silver.total_partitions"),
        F.col("f.row_count"),
        saved,
        has_report,
        total,
        has_report,
        quality,
        alerts,
        {"bronze": F.col("bronze.errors"), "silver": F.col("silver.errors")} if report_errors else None,
    )
    if failures:
        issues = F.concat(issues, F.array(*map(F.lit, failures)))
    return base.select(
        F.lit("end_to_end_integrated").alias("pipeline_type"),
        now.alias("completion_timestamp"),
        F.lit(run_id or "unknown").alias("run_id"),
        overall_status(issues).alias("overall_status"),
        F.struct(
            F.col("bronze").alias("bronze_layer"),
            F.col("silver").alias("silver_layer"),
            F.struct(
                F.col("f.row_count").alias("feature_rows"),
                F.col("f.column_count").alias("feature_columns"),
                F.col("l.row_count").alias("label_rows"),
                F.col("l.column_count").alias("label_columns"),
                F.lit(gold_status).alias("status"),
            ).alias("gold_layer"),
        ).alias("data_processing"),
        F.struct(
            saved.alias("model_saved"),
            F.lit(model_path).cast("string").alias("model_directory"),
            F.when(saved, storage_method).alias("storage_method"),
            F.lit(evaluation is not None).alias("has_oot_data"),
        ).alias("model_training"),
        F.struct(
            has_report.alias("predictions_generated"),
            total.alias("total_predictions"),
            of_report("positive_rate", F.lit(0.0)).alias("positive_rate"),
            of_report("threshold_used", F.lit(0.0)).alias("threshold_used"),
            has_report.alias("predictions_saved"),
            F.struct(
                F.col("e.oot_f1").alias("f1"), F.col("e.oot_f15").alias("f15"), F.col("e.oot_auc").alias("auc")
            ).alias("oot_performance"),
        ).alias("predictions"),
        F.struct(
            has_report.alias("monitoring_completed"),
            F.when(has_report, "completed").otherwise("failed").alias("monitoring_status"),
            quality.alias("data_quality_issues"),
            F.lit(performance).alias("performance_available"),
            alerts.alias("drift_alerts_count"),
            F.struct(
                (F.col("r.f1_score") if performance else nulls("double")).alias("f1"),
                (F.col("r.auc_score") if performance else nulls("double")).alias("auc"),
            ).alias("current_performance"),
        ).alias("monitoring"),
        issues.alias("issues"),
    )
