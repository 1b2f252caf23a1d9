"""Score distribution and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.operators import metrics, profiling
from featuremart.plans.training import evaluate_predictions

from .features import rounded
from .registry import Tables, query
from .standins import SCORES_SQL, scores

RATES = ("precision", "recall", "f1_score", "f15_score")

PERCENTILE_SQL = ", ".join(f"round(quantile_cont(prediction_proba, {p / 100}), 9) AS p{p}" for p in profiling.PERCENTS)

TOTALS_SQL = """count(*) AS total_predictions, CAST(sum(prediction_binary) AS BIGINT) AS positive_predictions,
       round(avg(prediction_binary), 9) AS positive_rate, round(avg(prediction_proba), 9) AS avg_prediction_proba,
       count(*) FILTER (WHERE prediction_proba < 0.01::DOUBLE) AS very_low,
       count(*) FILTER (WHERE prediction_proba > 0.99::DOUBLE) AS very_high"""

COUNTS_SQL = """count(*) FILTER (WHERE actual_label = 0 AND prediction_binary = 0) AS tn,
       count(*) FILTER (WHERE actual_label = 0 AND prediction_binary = 1) AS fp,
       count(*) FILTER (WHERE actual_label = 1 AND prediction_binary = 0) AS fn,
       count(*) FILTER (WHERE actual_label = 1 AND prediction_binary = 1) AS tp"""

RATES_SQL = """
       round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 9) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 9) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fn + fp, 0)::DOUBLE, 0), 9) AS f1_score,
       round(coalesce(3.25::DOUBLE * tp / nullif(3.25::DOUBLE * tp + 2.25::DOUBLE * fn + fp, 0), 0), 9) AS f15_score"""

AUC_SQL = """
       (sum(CASE WHEN actual_label = 1 THEN r END) - (count(*) FILTER (WHERE actual_label = 1))
        * (count(*) FILTER (WHERE actual_label = 1) + 1) / 2.0::DOUBLE)
       / nullif(CAST(count(*) FILTER (WHERE actual_label = 1) AS DOUBLE) * count(*) FILTER (WHERE actual_label = 0), 0)"""


def ranked_sql(over: str, score: str = "prediction_proba") -> str:
    """Mid-ranks of the score: ties share the middle of their places."""
    part = f"PARTITION BY {over}" if over else ""
    same = f"PARTITION BY {over + ',' if over else ''} {score}"
    return f"""ranked AS (
  SELECT *, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER ({same}) - 1) / 2.0::DOUBLE AS r FROM scores)"""


@query(
    "score_summary",
    f"WITH {SCORES_SQL} SELECT lang, {TOTALS_SQL}, {PERCENTILE_SQL} FROM scores GROUP BY 1",
)
def score_summary(t: Tables):
    rows = scores(t)
    totals = profiling.score_totals(rows, "prediction_proba", "prediction_binary", ["lang"])
    percentiles = profiling.score_percentiles(rows, "prediction_proba", ["lang"])
    names = [f"p{p}" for p in profiling.PERCENTS]
    return rounded(totals.join(percentiles, "lang"), ["positive_rate", "avg_prediction_proba", *names], 9)


@query(
    "price_percentiles",
    "SELECT "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p / 100}), 6) AS p{p}" for p in profiling.PERCENTS)
    + " FROM lineitem",
)
def price_percentiles(t: Tables):
    """Percentiles of a whole table without groups."""
    return rounded(profiling.score_percentiles(t.lineitem, "l_extendedprice"), [f"p{p}" for p in profiling.PERCENTS])


@query(
    "missing_profile",
    """
WITH holes AS (
  SELECT count(*) FILTER (WHERE c_acctbal < 0) AS a, count(*) FILTER (WHERE c_nationkey = 0) AS b,
         count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS c FROM customer)
SELECT * FROM (SELECT 'balance' AS "column", a AS missing FROM holes UNION ALL SELECT 'nation', b FROM holes
               UNION ALL SELECT 'segment', c FROM holes) WHERE missing > 0""",
)
def missing_profile(t: Tables):
    holes = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_nationkey", F.lit(0)).alias("nation"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    return profiling.missing_counts(holes)


@query(
    "confusion_metrics",
    f"""
WITH {SCORES_SQL}, c AS (SELECT lang, {COUNTS_SQL} FROM scores GROUP BY 1)
SELECT lang, tn, fp, fn, tp, {RATES_SQL} FROM c""",
)
def confusion_metrics(t: Tables):
    counts = metrics.confusion(scores(t), "actual_label", "prediction_binary", ["lang"])
    return rounded(metrics.with_rates(counts), RATES, 9)


@query(
    "out_of_time_metrics",
    f"""
WITH {SCORES_SQL}, c AS (SELECT {COUNTS_SQL} FROM scores), rates AS (SELECT {RATES_SQL} FROM c), {ranked_sql("")}
SELECT f1_score AS oot_f1, f15_score AS oot_f15, (SELECT round({AUC_SQL}, 9) FROM ranked) AS oot_auc FROM rates""",
)
def out_of_time_metrics(t: Tables):
    return rounded(evaluate_predictions(scores(t)), ["oot_f1", "oot_f15", "oot_auc"], 9)


@query(
    "class_report",
    f"""
WITH {SCORES_SQL}, c AS (SELECT {COUNTS_SQL} FROM scores),
classes AS (
  SELECT '0' AS "class", coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r,
         coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0) AS f, tn + fp AS support FROM c
  UNION ALL
  SELECT '1', coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0),
         coalesce(2 * tp / nullif(2 * tp + fn + fp, 0)::DOUBLE, 0), tp + fn FROM c),
report AS (
  SELECT * FROM classes
  UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + tn + fp + fn)::DOUBLE, tp + tn + fp + fn FROM c
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM classes
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f * support) / sum(support), sum(support) FROM classes)
SELECT "class", round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1_score, CAST(support AS BIGINT) AS support
FROM report""",
)
def class_report(t: Tables):
    report = metrics.class_report(scores(t), "actual_label", "prediction_binary")
    return rounded(report, ["precision", "recall", "f1_score"], 9)


@query("roc_auc", f"WITH {SCORES_SQL}, {ranked_sql('')} SELECT round({AUC_SQL}, 9) AS auc FROM ranked")
def roc_auc(t: Tables):
    return rounded(metrics.roc_auc(scores(t), "prediction_proba", "actual_label"), ["auc"], 9)


@query(
    "roc_auc_by_group",
    f"""
WITH {SCORES_SQL.replace("d.n_chars / (d.n_chars + 5000.0::DOUBLE) AS", "floor(d.n_chars / 500.0::DOUBLE) AS")},
{ranked_sql('lang')} SELECT lang, round({AUC_SQL}, 9) AS auc FROM ranked GROUP BY 1""",
)
def roc_auc_by_group(t: Tables):
    """Per language, with a coarse score so that many rows tie."""
    rows = t.labels.join(t.documents.select("doc_id", "lang", "n_chars"), "doc_id").select(
        "lang", F.col("quality").alias("label"), F.floor(F.col("n_chars") / 500.0).cast("double").alias("score")
    )
    return rounded(metrics.roc_auc(rows, "score", "label", ["lang"]), ["auc"], 9)


CURVE_SQL = f"""
{SCORES_SQL},
grid AS (SELECT i, 0.1::DOUBLE + i * ((0.1::DOUBLE + 0.01::DOUBLE) - 0.1::DOUBLE) AS threshold
         FROM (SELECT unnest(generate_series(0, 79)) AS i)),
curve AS (
  SELECT i, threshold,
         count(*) FILTER (WHERE actual_label = 1 AND prediction_proba > threshold) AS tp,
         count(*) FILTER (WHERE actual_label = 0 AND prediction_proba > threshold) AS fp,
         count(*) FILTER (WHERE actual_label = 1 AND prediction_proba <= threshold) AS fn,
         count(*) FILTER (WHERE actual_label = 0 AND prediction_proba <= threshold) AS tn
  FROM grid, scores GROUP BY ALL),
rated AS (SELECT *, coalesce(2 * tp / nullif(2 * tp + fn + fp, 0)::DOUBLE, 0) AS f1 FROM curve)"""


@query(
    "threshold_curve",
    f'WITH {CURVE_SQL} SELECT CAST(i AS INTEGER) AS "index", threshold, tp, fp, fn, tn, round(f1, 9) AS f1_score FROM rated',
)
def threshold_curve(t: Tables):
    return rounded(metrics.threshold_curve(scores(t), "prediction_proba", "actual_label"), ["f1_score"], 9)


@query(
    "threshold_search",
    f"WITH {CURVE_SQL} SELECT threshold, round(f1, 9) AS f1_score FROM rated ORDER BY f1 DESC, i LIMIT 1",
)
def threshold_search(t: Tables):
    curve = metrics.threshold_curve(scores(t), "prediction_proba", "actual_label")
    return rounded(metrics.best_threshold(curve), ["f1_score"], 9)
