"""Silver, gold, monitoring and run log on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featuremart.operators.boosting import FULL_GRID, best_candidate, classifier, grid_points, supported
from featuremart.plans import gold, monitoring, runlog, silver

D = dt.date
LMS_COLUMNS = ", ".join(f"{c} string" for c in silver.LMS)


def lms_row(overdue="0", due="100", installment="6", snapshot="2023-07-01"):
    return ("L", "C", "2023-01-01", "10", installment, "1000", due, "0", overdue, "500", snapshot)


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="no cleaner"):
        silver.clean("nothing", spark.range(1))


def test_clean_lms_fills_every_numeric_null(spark):
    out = silver.clean_lms(spark.createDataFrame([lms_row(installment=None, due=None)], LMS_COLUMNS)).first()
    assert (out["mob"], out["due_amt"], out["installments_missed"], out["dpd"]) == (0, 0.0, 0, 0)
    some = silver.clean_lms(spark.createDataFrame([lms_row(installment=None)], LMS_COLUMNS), fill=["installments_missed"]).first()
    assert some["mob"] is None


def test_overdue_without_a_due_amount_is_counted(spark):
    lms = silver.clean_lms(spark.createDataFrame([lms_row("50", "0"), lms_row("100", "100"), lms_row()], LMS_COLUMNS))
    assert [tuple(r) for r in silver.unresolved_overdue(lms).collect()] == [(D(2023, 7, 1), 1)]
    labels = sorted(r["label"] for r in gold.build_labels(lms).collect())
    assert labels == [0, 0, 1]


def test_rejected_values(spark):
    raw = spark.createDataFrame([("x", "2023-01-01"), ("5", "2023-01-01"), ("", "2023-01-01"), (None, "2023-02-01")], "a string, snapshot_date string")
    got = {r["snapshot_date"]: r["rejected_values"] for r in silver.rejected_values(raw, {"a": "int", "snapshot_date": "date"}).collect()}
    assert got == {D(2023, 1, 1): 1, D(2023, 2, 1): 0}


def predictions(spark, labelled=True, extreme=False):
    data = [(1, 0.9, 1), (1, 0.8, 0), (0, 0.2, 0), (0, 0.995 if extreme else 0.1, 1)]
    df = spark.createDataFrame(data, "prediction_binary int, prediction_proba double, actual_label int")
    df = df.withColumns({"threshold_used": F.lit(0.5), "model_run_id": F.lit("r"), "customer_id": F.lit("c")})
    return df if labelled else df.drop("actual_label")


def test_report(spark):
    row = monitoring.monitoring_report(predictions(spark), baseline_auc=0.9).first()
    assert (row["run_id"], row["total_predictions"], row["positive_predictions"]) == ("r", 4, 2)
    assert row["confusion_matrix"].asDict() == {"tn": 1, "fp": 1, "fn": 1, "tp": 1}
    assert (row["precision"], row["auc_score"]) == (0.5, 0.5)
    assert row["drift_alerts"] == ["HIGH AUC DRIFT: 0.4000"]
    assert row["data_quality"]["missing_values"] == {} and row["data_quality_issues"] is False
    assert row["prob_percentiles"]["p50"] == pytest.approx(0.5)


def test_report_without_drift_or_labels(spark):
    assert monitoring.monitoring_report(predictions(spark), baseline_auc=0.52).first()["drift_alerts"] == []
    assert monitoring.monitoring_report(predictions(spark)).first()["drift_alerts"] == []
    row = monitoring.monitoring_report(predictions(spark, labelled=False)).first()
    assert row["has_performance_metrics"] is False and "auc_score" not in row.asDict()


def test_report_without_predictions(spark):
    row = monitoring.monitoring_report(predictions(spark).filter("false"), baseline_auc=0.9).first()
    assert (row["total_predictions"], row["positive_predictions"], row["auc_score"], row["drift_alerts"]) == (0, 0, None, [])
    summarised = summary(spark, run_log(spark), monitoring.monitoring_report(predictions(spark).filter("false")))
    assert summarised["issues"] == ["No predictions generated"]


def run_log(spark, failed=0):
    expected = spark.createDataFrame([("lms", D(2023, m, 1)) for m in (1, 2)], "table_name string, snapshot_date date")
    counts = spark.createDataFrame([("lms", D(2023, m, 1), 5) for m in (1, 2)][failed:], "table_name string, snapshot_date date, rows long")
    return runlog.partition_log(expected, counts, "bronze").unionByName(runlog.partition_log(expected, counts, "silver"))


def summary(spark, log, report, **kwargs):
    return runlog.run_summary(spark, log, spark.range(3), spark.range(3), "r", "models/r", report=report, **kwargs).first()


def test_summary_of_a_clean_run(spark):
    row = summary(spark, run_log(spark), monitoring.monitoring_report(predictions(spark)))
    assert row["overall_status"] == "completed_successfully" and row["issues"] == []
    assert row["data_processing"]["bronze_layer"].asDict() == {"tables_processed": 1, "total_partitions": 2, "errors": 0}
    assert row["monitoring"]["current_performance"]["auc"] == 0.5
    assert row["predictions"]["total_predictions"] == 4


def test_summary_flags_issues(spark):
    report = monitoring.monitoring_report(predictions(spark, extreme=True), baseline_auc=0.9)
    row = summary(spark, run_log(spark, failed=1), report)
    assert row["overall_status"] == "completed_with_issues"
    assert row["issues"] == [
        "Data quality issues detected", "1 model drift alerts", "1 bronze partitions failed", "1 silver partitions failed",
    ]
    assert summary(spark, run_log(spark, failed=1), report, report_errors=False)["issues"] == row["issues"][:2]


def test_summary_of_a_run_that_stopped_early(spark):
    empty = run_log(spark).filter("false")
    row = runlog.run_summary(spark, empty, spark.range(0), spark.range(0)).first()
    assert row["issues"] == [
        "No bronze tables processed successfully", "No silver tables processed successfully", "No feature data generated",
        "Model training failed", "Prediction generation failed", "Model monitoring failed",
    ]
    assert row["run_id"] == "unknown" and row["predictions"]["total_predictions"] == 0


def test_grid(caplog):
    assert len(grid_points(FULL_GRID)) == 2916
    with caplog.at_level("WARNING"):
        kept = supported(FULL_GRID)
    assert "reg_alpha, reg_lambda" in caplog.text and len(grid_points(kept)) == 324


def test_classifier_parameters(spark):
    model = classifier({"n_estimators": 7, "colsample_bytree": 0.8, "subsample": 0.9, "min_child_weight": 3})
    assert (model.getMaxIter(), model.getMaxDepth(), model.getStepSize(), model.getSeed()) == (7, 6, 0.1, 42)
    assert (model.getFeatureSubsetStrategy(), model.getSubsamplingRate(), model.getMinInstancesPerNode()) == ("0.8", 0.9, 3)


def test_best_candidate_takes_the_first_of_equals(spark):
    results = spark.createDataFrame(
        [(0, {"max_depth": "2"}, 0.9, 0.5), (1, {"max_depth": "3", "subsample": "0.8"}, 0.6, 0.7), (2, {"max_depth": "4"}, 0.6, 0.7)],
        "candidate int, params map<string,string>, train_f1 double, val_f1 double",
    )
    assert best_candidate(results) == {"max_depth": 3, "subsample": 0.8}


def test_search_hands_back_the_winner_fitted_on_train(spark):
    import random

    from featuremart.operators import boosting

    rnd = random.Random(4)
    data = [(float(rnd.gauss(y, 0.7)), float(rnd.random()), y, "val" if i % 4 == 0 else "train") for i in range(200) for y in (0, 1)]
    rows = boosting.assemble(spark.createDataFrame(data, "a double, b double, label int, split string"), ["a", "b"])
    found = boosting.search(rows, {"n_estimators": [2], "max_depth": [1, 3], "reg_alpha": [0, 1]})
    assert found.candidates.count() == 2
    assert found.best_params == best_candidate(found.candidates)
    again = boosting.train(rows.filter("split = 'train'"), found.best_params)
    assert again.toDebugString.split("\n", 1)[1] == found.best_model.toDebugString.split("\n", 1)[1]


def test_pairing_stops_on_repeated_keys(spark):
    from featuremart.operators.splits import TimeWindows
    from featuremart.plans import training

    day = lambda m: dt.date(2024, m, 1)
    features = spark.createDataFrame([("a", day(1), 1), ("a", day(3), 3), ("a", day(12), 9)], "customer_id string, snapshot_date date, x int")
    labels = spark.createDataFrame(
        [("l1", "a", 1, day(9)), ("l2", "a", 0, day(8)), ("l3", "a", 0, day(6)), ("l4", "b", 1, day(9))],
        "loan_id string, customer_id string, label int, snapshot_date date",
    )
    windows = TimeWindows.before(dt.date(2024, 10, 1))
    paired = training.labelled_rows(features, labels, windows)
    assert {(r["loan_id"], r["x"]) for r in paired.collect()} == {("l1", 3), ("l2", 1)}
    counts = training.pairing_counts(features, labels, paired)
    merged = {"label_rows": 4, "merged_rows": 0, "differing_loans": 0, "rows_without_loan": 0}
    assert counts == merged | {"loans": 4, "paired": 2, "repeated_features": 0, "repeated_loans": 0}
    training.check_pairing(counts)
    twice = features.union(features.limit(1))
    with pytest.raises(ValueError, match="'repeated_features': 1"):
        training.check_pairing(training.pairing_counts(twice, labels, training.labelled_rows(twice, labels, windows)))


def test_a_loan_has_one_label(spark):
    """Two equal rows, two that differ on a date, two that differ in date, and rows without a loan or a date."""
    from featuremart.operators.splits import TimeWindows
    from featuremart.plans import training

    day = lambda m: dt.date(2024, m, 1)
    rows = [("same", "a", 1, day(9)), ("same", "a", 1, day(9)), ("worse", "a", 0, day(9)), ("worse", "a", 1, day(9))]
    rows += [("later", "a", 1, day(9)), ("later", "a", 0, day(8)), (None, "a", 1, day(9)), (None, "b", 0, day(8))]
    rows += [("undated", "a", 1, None), ("undated", "a", 0, day(9)), ("unknown", "b", None, day(9)), ("unknown", "c", 0, day(9)), ("shared", "b", 1, day(9)), ("shared", "a", 1, day(9))]
    labels = spark.createDataFrame(rows, "loan_id string, customer_id string, label int, snapshot_date date").repartition(4)
    got = training.resolve_labels(labels)
    assert got.columns == labels.columns and got.dtypes == labels.dtypes
    assert {tuple(r) for r in got.collect()} == {
        ("same", "a", 1, day(9)), ("worse", "a", 1, day(9)), ("later", "a", 0, day(8)), ("undated", "a", 0, day(9)),
        ("unknown", "c", 0, day(9)), ("shared", "a", 1, day(9)),
    }
    features = spark.createDataFrame([("a", day(1), 1), ("a", day(3), 3)], "customer_id string, snapshot_date date, x int")
    paired = training.labelled_rows(features, labels, TimeWindows.before(dt.date(2024, 10, 1)))
    assert sorted((r["loan_id"], r["x"]) for r in paired.collect()) == [("later", 1), ("same", 3), ("shared", 3), ("undated", 3), ("worse", 3)]
    counts = training.pairing_counts(features, labels, paired)
    assert counts == {
        "label_rows": 14, "loans": 6, "merged_rows": 6, "differing_loans": 4, "rows_without_loan": 2,
        "paired": 5, "repeated_features": 0, "repeated_loans": 0,
    }
    training.check_pairing(counts)
    assert training.merge_messages(counts) == ["labels: 6 rows merged, 4 loans with differing rows", "labels: 2 rows without a loan left out"]
    none = labels.limit(0)
    assert training.label_merges(none).first().asDict() == dict.fromkeys(training.label_merges(none).columns, 0)
