"""Monitoring report, drift, run log and issue rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.operators import metrics
from featuremart.plans import monitoring, runlog
from featuremart.sources import spine
from featuremart.sources.scratch import cut, scratch_dir

from .features import rounded
from .layers import PARTITIONS_SQL, expected_partitions, present_partitions
from .registry import Tables, query
from .scores import AUC_SQL, COUNTS_SQL, PERCENTILE_SQL, RATES_SQL, TOTALS_SQL, ranked_sql
from .standins import SCORES_SQL, THRESHOLD, scores


def predictions(t: Tables):
    """Scored rows in the form of the predictions table, some customers unknown; a written table, as
    predictions are."""
    rows = scores(t).select(
        "prediction_binary",
        "prediction_proba",
        F.lit(THRESHOLD).alias("threshold_used"),
        F.lit("run-1").alias("model_run_id"),
        F.nullif("lang", F.lit("de")).alias("customer_id"),
        "actual_label",
    )
    return cut(rows, "predictions")


@query(
    "monitoring_report",
    f"""
WITH {SCORES_SQL}, {ranked_sql('')}, c AS (SELECT {COUNTS_SQL} FROM scores),
totals AS (SELECT {TOTALS_SQL}, {PERCENTILE_SQL}, count(*) FILTER (WHERE lang = 'de') AS missing_customers FROM scores),
a AS (SELECT {AUC_SQL} AS auc FROM ranked)
SELECT 'run-1' AS run_id, {THRESHOLD}::DOUBLE AS threshold_used, totals.*, tn, fp, fn, tp, {RATES_SQL}, round(auc, 9) AS auc_score,
       missing_customers > 0 OR very_low + very_high > 0 AS data_quality_issues,
       CASE WHEN abs(auc - 0.9::DOUBLE) > 0.05 THEN printf('HIGH AUC DRIFT: %.4f', abs(auc - 0.9::DOUBLE)) END AS drift_alert
FROM totals, c, a""",
)
def monitoring_report(t: Tables):
    """The nested report, flattened for comparison."""
    report = monitoring.monitoring_report(predictions(t), baseline_auc=0.9)
    flat = report.select(
        "run_id",
        "threshold_used",
        "total_predictions",
        "positive_predictions",
        "positive_rate",
        "avg_prediction_proba",
        "prob_percentiles.*",
        "confusion_matrix.*",
        "precision",
        "recall",
        "f1_score",
        "f15_score",
        "auc_score",
        "data_quality_issues",
        "data_quality.extreme_probabilities.*",
        F.coalesce(F.try_element_at("data_quality.missing_values", F.lit("customer_id")), F.lit(0)).alias(
            "missing_customers"
        ),
        F.get("drift_alerts", F.lit(0)).alias("drift_alert"),
    )
    return rounded(
        flat,
        ["positive_rate", "avg_prediction_proba", "p10", "p25", "p50", "p75", "p90"]
        + ["precision", "recall", "f1_score", "f15_score", "auc_score"],
        9,
    )


@query(
    "report_sink",
    f"""
WITH {SCORES_SQL}, {ranked_sql('')}
SELECT 'run-1' AS run_id, count(*) AS total_predictions, round({AUC_SQL}, 9) AS auc_score,
       round(avg(prediction_proba), 9) AS avg_prediction_proba FROM ranked""",
)
def report_sink(t: Tables):
    """The report as JSON, read back."""
    path = scratch_dir(t.spark, "report")
    monitoring.write_report(monitoring.monitoring_report(predictions(t)), path)
    schema = "run_id string, total_predictions long, auc_score double, avg_prediction_proba double"
    return rounded(t.spark.read.schema(schema).json(path), ["auc_score", "avg_prediction_proba"], 9)


@query(
    "drift_alert",
    f"""
WITH {SCORES_SQL}, {ranked_sql('')}, base AS (SELECT {AUC_SQL} AS baseline_auc FROM ranked),
by_lang AS (WITH {ranked_sql('lang')} SELECT lang, {AUC_SQL} AS auc FROM ranked GROUP BY 1)
SELECT lang, round(auc, 9) AS auc, round(baseline_auc, 9) AS baseline_auc, round(abs(auc - baseline_auc), 9) AS auc_drift,
       CASE WHEN abs(auc - baseline_auc) > 0.05 THEN printf('HIGH AUC DRIFT: %.4f', abs(auc - baseline_auc)) END AS drift_alert
FROM by_lang, base""",
)
def drift_alert(t: Tables):
    """Each language against all of them."""
    rows = scores(t)
    by_lang = metrics.roc_auc(rows, "prediction_proba", "actual_label", ["lang"])
    overall = metrics.roc_auc(rows, "prediction_proba", "actual_label")
    return rounded(monitoring.drift_by_run(by_lang, overall), ["auc", "baseline_auc", "auc_drift"], 9)


LOG_SQL = f"""
{PARTITIONS_SQL},
log AS (
  SELECT 'bronze' AS layer, e.table_name, e.snapshot_date, coalesce(n, 0) AS rows,
         CASE WHEN n > 0 THEN 'processed' ELSE 'failed' END AS status,
         CASE WHEN n > 0 THEN NULL ELSE concat('no rows in ', e.table_name, ' for ', CAST(e.snapshot_date AS VARCHAR)) END AS error
  FROM expected e LEFT JOIN present p ON e.table_name = p.table_name AND e.snapshot_date = p.snapshot_date)"""


def bronze_log(t: Tables):
    return runlog.partition_log(expected_partitions(t), present_partitions(t), "bronze")


@query("run_log", f"WITH {LOG_SQL} SELECT * FROM log")
def run_log(t: Tables):
    return bronze_log(t)


@query(
    "run_log_summary",
    f"""
WITH {LOG_SQL}
SELECT layer, table_name, count(*) FILTER (WHERE status = 'processed') AS partitions_processed,
       count(*) FILTER (WHERE status = 'failed') AS partitions_failed, CAST(sum(rows) AS BIGINT) AS rows
FROM log GROUP BY ALL""",
)
def run_log_summary(t: Tables):
    return runlog.table_log(bronze_log(t))


@query(
    "usable_upstream",
    f"WITH {LOG_SQL} SELECT table_name, snapshot_date FROM log WHERE status = 'processed'",
)
def usable_upstream(t: Tables):
    """Partitions whose upstream was processed; the others would be skipped."""
    return spine.usable_partitions(expected_partitions(t), bronze_log(t), ["table_name", "snapshot_date"])


@query(
    "issue_rules",
    f"""
WITH {LOG_SQL},
per_table AS (SELECT table_name, count(*) FILTER (WHERE status = 'processed') AS good,
                     count(*) FILTER (WHERE status = 'failed') AS bad FROM log GROUP BY 1),
cases AS (SELECT *, (SELECT count(*) FROM labels) AS predictions FROM per_table)
SELECT table_name, good, bad,
       CASE WHEN bad > 0 THEN 'completed_with_issues' ELSE 'completed_successfully' END AS overall_status,
       CASE WHEN bad > 0 THEN concat(bad, ' bronze partitions failed') ELSE '' END AS issues
FROM cases""",
)
def issue_rules(t: Tables):
    """The rules, applied to the log of each table as if it were a run of its own."""
    log = runlog.table_log(bronze_log(t))
    made = t.labels.agg(F.count(F.lit(1))).scalar()
    yes, no = F.lit(True), F.lit(False)
    found = runlog.issue_messages(
        F.col("good"), F.col("good"), F.col("rows"), yes, yes, F.col("made"), yes, no, F.lit(0), {"bronze": F.col("bad")}
    )
    cases = log.select(
        "table_name",
        F.col("partitions_processed").alias("good"),
        F.col("partitions_failed").alias("bad"),
        "rows",
        made.alias("made"),
    ).withColumn("found", found)
    return cases.select(
        "table_name",
        "good",
        "bad",
        runlog.overall_status(F.col("found")).alias("overall_status"),
        F.array_join("found", "; ").alias("issues"),
    )


@query(
    "run_summary",
    f"""
WITH {LOG_SQL}, {SCORES_SQL}
SELECT 'run-1' AS run_id, 'completed_with_issues' AS overall_status,
       (SELECT count(DISTINCT table_name) FROM log WHERE status = 'processed') AS bronze_tables,
       (SELECT count(*) FROM log WHERE status = 'processed') AS bronze_partitions,
       (SELECT count(*) FROM log WHERE status = 'failed') AS bronze_errors, 0 AS silver_partitions,
       (SELECT count(*) FROM documents) AS feature_rows, (SELECT count(*) FROM labels) AS label_rows,
       (SELECT count(*) FROM scores) AS total_predictions,
       concat('No silver tables processed successfully; Data quality issues detected; 1 model drift alerts; ',
              (SELECT count(*) FROM log WHERE status = 'failed'), ' bronze partitions failed') AS issues""",
)
def run_summary(t: Tables):
    report = cut(monitoring.monitoring_report(predictions(t), baseline_auc=0.9), "report")
    summary = runlog.run_summary(
        t.spark, bronze_log(t), t.documents, t.labels, "run-1", model_path="models/run-1", report=report
    )
    layers = "data_processing"
    return summary.select(
        "run_id",
        "overall_status",
        F.col(f"{layers}.bronze_layer.tables_processed").alias("bronze_tables"),
        F.col(f"{layers}.bronze_layer.total_partitions").alias("bronze_partitions"),
        F.col(f"{layers}.bronze_layer.errors").alias("bronze_errors"),
        F.col(f"{layers}.silver_layer.total_partitions").cast("int").alias("silver_partitions"),
        F.col(f"{layers}.gold_layer.feature_rows").alias("feature_rows"),
        F.col(f"{layers}.gold_layer.label_rows").alias("label_rows"),
        F.col("predictions.total_predictions").alias("total_predictions"),
        F.array_join("issues", "; ").alias("issues"),
    )


RUN_SCORES_SQL = SCORES_SQL.replace("SELECT l.doc_id,", "SELECT l.doc_id, concat('run-', l.doc_id % 3) AS run_id,")


@query(
    "drift_history",
    f"""
WITH {RUN_SCORES_SQL}, {ranked_sql('run_id')}, aucs AS (SELECT run_id, {AUC_SQL} AS auc FROM ranked GROUP BY 1),
base AS (SELECT auc AS baseline_auc FROM aucs WHERE run_id = 'run-0')
SELECT run_id, CASE WHEN run_id <> 'run-9' THEN 'run-0' END AS model_run_id, round(auc, 9) AS auc,
       round(baseline_auc, 9) AS baseline_auc, round(abs(auc - baseline_auc), 9) AS auc_drift,
       CASE WHEN abs(auc - baseline_auc) > 0.01 THEN printf('HIGH AUC DRIFT: %.4f', abs(auc - baseline_auc)) END AS drift_alert
FROM aucs, base WHERE run_id <> 'run-0'
UNION ALL
SELECT 'run-9', 'unknown', round(auc, 9), NULL, NULL, NULL FROM aucs WHERE run_id = 'run-1'""",
)
def drift_history(t: Tables):
    """Three stored runs: one of training, two scored with its model, and one whose model is unknown. One
    of them is stored twice."""
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.concat(F.lit("run-"), (F.col("doc_id") % 3).cast("string")).alias("run_id"),
        F.col("quality").alias("label"),
        (F.col("n_chars") / (F.col("n_chars") + F.lit(5000.0))).alias("score"),
    )
    aucs = cut(metrics.roc_auc(rows, "score", "label", ["run_id"]), "aucs")
    kind = F.when(F.col("run_id") == "run-0", "training").otherwise("monitoring").alias("kind")
    stored = aucs.select(kind, "run_id", F.lit("run-0").alias("model_run_id"), "auc")
    path = scratch_dir(t.spark, "metrics")
    monitoring.store_metrics(stored.withColumn("auc", F.lit(0.0)).filter("run_id = 'run-1'"), path)
    monitoring.store_metrics(stored, path)
    unknown = stored.filter("run_id = 'run-1'").withColumns({"run_id": F.lit("run-9"), "model_run_id": F.lit("unknown")})
    monitoring.store_metrics(unknown, path)
    history = monitoring.drift_history(monitoring.stored_metrics(t.spark, path), tolerance=0.01)
    return rounded(history, ["auc", "baseline_auc", "auc_drift"], 9)


BROKEN = "ValueError: broken file"


@query(
    "resume_log",
    f"""
WITH {PARTITIONS_SQL},
state AS (
  SELECT e.table_name, e.snapshot_date, coalesce(n, 0) AS rows, coalesce(n > 0 AND year(e.snapshot_date) <> 1997, false) AS first_good
  FROM expected e LEFT JOIN present p ON e.table_name = p.table_name AND e.snapshot_date = p.snapshot_date)
SELECT 'bronze' AS layer, table_name, snapshot_date, CASE WHEN first_good THEN 'run-1' ELSE 'run-2' END AS run_id,
       CAST(CASE WHEN first_good THEN 1 ELSE 2 END AS INTEGER) AS attempt, rows,
       CASE WHEN rows > 0 THEN 'processed' ELSE 'failed' END AS status,
       CASE WHEN rows = 0 THEN concat('no rows in ', table_name, ' for ', CAST(snapshot_date AS VARCHAR)) END AS error
FROM state""",
)
def resume_log(t: Tables):
    """Two attempts: in the first the partitions of 1997 can't be read, the second takes up what failed."""
    path = scratch_dir(t.spark, "run-log")
    expected, present = expected_partitions(t), present_partitions(t)
    broken = present.filter(F.year("snapshot_date") == 1997).withColumn("reason", F.lit(BROKEN))
    runlog.append_log(runlog.partition_log(expected, present, "bronze", broken), path, "run-1", 1)
    schema = "run_id string, attempt int, layer string, table_name string, snapshot_date date, rows long, status string, error string"
    history = t.spark.read.schema(schema).parquet(path)
    todo = cut(runlog.pending(expected, history, "bronze"), "pending")
    runlog.append_log(runlog.partition_log(todo, present, "bronze"), path, "run-2", 2)
    return runlog.latest_status(t.spark.read.schema(schema).parquet(path))


@query(
    "quarantined_partitions",
    f"""
WITH {PARTITIONS_SQL}
SELECT table_name, count(*) FILTER (WHERE year(snapshot_date) <> 1997) AS partitions_processed,
       count(*) FILTER (WHERE year(snapshot_date) = 1997) AS partitions_failed,
       max(CASE WHEN year(snapshot_date) = 1997 THEN '{BROKEN}' END) AS error
FROM present GROUP BY 1""",
)
def quarantined_partitions(t: Tables):
    """Partitions that exist but are set aside with a reason, next to those that went on."""
    present = present_partitions(t)
    broken = present.filter(F.year("snapshot_date") == 1997).withColumn("reason", F.lit(BROKEN))
    log = runlog.partition_log(present, present, "bronze", broken)
    errors = log.groupBy("table_name").agg(F.max("error").alias("error"))
    counts = runlog.table_log(log).select("table_name", "partitions_processed", "partitions_failed")
    return counts.join(errors, "table_name")
