"""The whole run from raw files to the summary."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from credit import MONTHS, write_portfolio
from featuremart.plans import gold, medallion
from featuremart.plans.training import load_run
from featuremart.sources.tables import read_partitions, read_raw_csv

GRID = {"n_estimators": [3], "max_depth": [2, 3]}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("portfolio")
    files = write_portfolio(folder)
    root = str(folder / "mart")
    row = medallion.run_all(
        spark, files, root, "r1", grid=GRID, baseline_params={"n_estimators": 3, "max_depth": 2}
    ).first()
    return files, root, row


def test_layers(spark, run):
    _, root, row = run
    layers = row["data_processing"]
    assert layers["bronze_layer"]["tables_processed"] == layers["silver_layer"]["tables_processed"] == 4
    # Attributes and financials exist for the 18 start months only, clicks for 19, the ledger for 24.
    assert layers["bronze_layer"]["total_partitions"] == layers["silver_layer"]["total_partitions"] == 18 + 18 + 19 + 24
    assert layers["bronze_layer"]["errors"] == 96 - 79
    assert "17 bronze partitions failed" in row["issues"]


def test_feature_store_has_the_74_columns(spark, run):
    _, root, row = run
    features = read_partitions(spark, f"{root}/gold/feature_store")
    assert len(features.columns) == 74 == row["data_processing"]["gold_layer"]["feature_columns"]
    groups = {
        "occupation_": 15, "payment_of_min_amount_": 3, "credit_mix_": 3, "payment_behaviour_spent_": 2,
        "payment_behaviour_value_": 3, "avg_fe_": 20,
    }
    for prefix, n in groups.items():
        assert len([c for c in features.columns if c.startswith(prefix)]) == n, prefix
    assert "credit-builder_loan" in features.columns and "media_manager" not in features.columns
    nulls = features.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in features.columns]).first()
    assert sum(nulls) == 0


def test_labels(spark, run):
    _, root, _ = run
    labels = read_partitions(spark, f"{root}/gold/label_store")
    assert set(labels.columns) == {"loan_id", "customer_id", "label", "label_def", "snapshot_date"}
    assert [r[0] for r in labels.select("label_def").distinct().collect()] == ["30dpd_6mob"]
    assert {r[0] for r in labels.select("label").distinct().collect()} == {0, 1}


def test_click_averages_match_the_raw_file(spark, run):
    files, root, _ = run
    clicks = read_raw_csv(spark, files["clickstream"]).filter("Customer_ID = 'CUS_0005'").collect()
    start = MONTHS[5]
    known = [int(r["fe_3"]) for r in clicks if r["snapshot_date"] <= start]
    features = read_partitions(spark, f"{root}/gold/feature_store").filter("customer_id = 'CUS_0005'").first()
    assert features["avg_fe_3"] == pytest.approx(sum(known) / len(known))


def test_predictions(spark, run):
    _, root, row = run
    predictions = spark.read.parquet(f"{root}/predictions")
    assert set(predictions.columns) == {
        "prediction_binary", "prediction_proba", "threshold_used", "model_run_id", "prediction_timestamp",
        "customer_id", "snapshot_date", "actual_label",
    }
    assert predictions.count() == row["predictions"]["total_predictions"] > 0
    saved = load_run(spark, f"{root}/models/run_r1")
    labels = saved.oot.select("label_date").distinct().collect()
    assert {r[0] for r in labels} <= {dt.date(2024, m, 1) for m in (10, 11, 12)}
    assert row["predictions"]["threshold_used"] == saved.threshold
    assert len(saved.columns) == 72


def test_reports_are_json(spark, run):
    _, root, row = run
    report = json.loads(spark.read.text(f"{root}/predictions_reports/monitoring_r1").first()[0])
    assert report["total_predictions"] == row["predictions"]["total_predictions"]
    assert set(report["prob_percentiles"]) == {"p10", "p25", "p50", "p75", "p90"}
    summary = json.loads(spark.read.text(f"{root}/predictions_reports/summary_r1").first()[0])
    assert summary["overall_status"] == row["overall_status"]


def test_fitting_on_train_differs_from_fitting_on_all(spark, run):
    """A late customer with a huge income moves the mean only when all rows are used."""
    _, root, _ = run
    t = {n: read_partitions(spark, f"{root}/silver/{n}") for n in ("attributes", "financials", "loan_type", "clickstream", "lms")}
    labels = gold.build_labels(t["lms"])
    late = F.col("snapshot_date") > F.lit("2024-05-01").cast("date")
    bent = t["financials"].withColumn("changed_credit_limit", F.when(late, 1e6).otherwise(F.col("changed_credit_limit")))
    args = (t["attributes"], bent, t["loan_type"], t["clickstream"], t["lms"], labels)
    early = labels.filter(F.col("snapshot_date") < "2024-06-01")

    def filled(df):
        return df.filter(~late).agg(F.max("changed_credit_limit")).first()[0]

    assert filled(gold.build_features(*args, fit_customers=early)) < 100 < filled(gold.build_features(*args))


def test_missing_source_is_skipped_and_logged(spark, run, tmp_path):
    log = medallion.layer_partition_log(spark, "bronze", run[1] + "/bronze", ["lms"], MONTHS)
    failed = {r["table_name"]: r["n"] for r in log.filter("status = 'failed'").groupBy("table_name").agg(F.count("*").alias("n")).collect()}
    assert failed == {"attributes": 24, "financials": 24, "clickstream": 24}


def test_table_without_any_partition_is_logged(spark, run, tmp_path):
    root = str(tmp_path / "bronze")
    medallion.write_bronze(spark, "lms", run[0]["lms"], root, ["1999-01-01"])
    log = medallion.layer_partition_log(spark, "bronze", root, ["lms"], ["1999-01-01"])
    assert {(r["table_name"], r["status"]) for r in log.collect()} == {(t, "failed") for t in medallion.TABLES}


def test_label_filter_reaches_the_scan(spark, run):
    labels = gold.build_labels(read_partitions(spark, f"{run[1]}/silver/lms", dates=MONTHS[:3]))
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mob,6)" in plan and "loan_amt" not in plan
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan or "PartitionFilters: [snapshot_date" in plan


def test_running_again_changes_nothing(spark, run):
    """Bronze and silver of a date can be rebuilt; the other dates stay as they are."""
    files, root, _ = run
    before = read_partitions(spark, f"{root}/silver/lms").count()
    medallion.write_bronze(spark, "lms", files["lms"], f"{root}/bronze", [MONTHS[3]])
    medallion.write_silver(spark, "lms", f"{root}/bronze", f"{root}/silver", [MONTHS[3]])
    assert read_partitions(spark, f"{root}/silver/lms").count() == before


def test_the_run_goes_on_after_failures(spark, run, tmp_path):
    """Without a source, and with a column missing, logs and a summary are written that name the cause."""
    files = dict(run[0])
    del files["clickstream"]
    bad = str(tmp_path / "attributes.csv")
    spark.read.option("header", True).csv(files["attributes"]).drop("SSN").write.option("header", True).csv(bad)
    root = str(tmp_path / "root")
    files["attributes"] = bad
    summary = medallion.run_all(spark, files, root, "broken", start=MONTHS[0], end=MONTHS[-1]).first()
    assert summary["overall_status"] == "completed_with_issues"
    text = "\n".join(summary["issues"])
    for part in ("bronze clickstream: no source", "silver attributes: ValueError", "ssn", "gold: ", "No feature data generated"):
        assert part in text
    for part in ("Model training failed", "Prediction generation failed", "Model monitoring failed"):
        assert part in text
    assert summary["data_processing"]["gold_layer"]["status"] == "failed"
    assert spark.read.parquet(f"{root}/logs/bronze_broken").count() and spark.read.parquet(f"{root}/logs/silver_broken").count()


def test_wide_categories_are_stored_in_long_form(spark, run, tmp_path):
    _, root, _ = run
    place = str(tmp_path / "gold")
    features, _ = gold.write_gold(spark, f"{root}/silver", place, MONTHS, widest=3)
    long = read_partitions(spark, f"{place}/feature_categories")
    assert {r[0] for r in long.select("column").distinct().collect()} == {"occupation"}
    values = read_partitions(spark, f"{root}/silver/attributes").select("customer_id", "snapshot_date", "occupation")
    keys = ["customer_id", "snapshot_date"]
    want = features.select(*keys, "occupation__other").join(values, keys).filter("occupation is not null")
    got = features.select(*keys, "occupation__other").join(long.select(*keys, "category"), keys)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("occupation__other = 1").select("category").distinct().count() == 12
    gold.write_gold(spark, f"{root}/silver", place, MONTHS)
    assert not (tmp_path / "gold" / "feature_categories").exists() or not list((tmp_path / "gold" / "feature_categories").glob("snapshot_date=*"))


def statuses(log, table):
    return {(r["layer"], str(r["snapshot_date"])): r["status"] for r in log.filter(F.col("table_name") == table).collect()}


def written_files(root, table):
    from pathlib import Path

    return {str(p): p.stat().st_mtime_ns for p in Path(root, "silver", table).glob("snapshot_date=*/*.parquet")}


def test_one_broken_date_of_24_is_set_aside_and_taken_up_again(spark, run, tmp_path):
    """The other 23 dates are written; the next attempt touches the broken date only."""
    files, root = run[0], str(tmp_path / "root")
    for t in medallion.TABLES:
        medallion.write_bronze(spark, t, files[t], f"{root}/bronze", MONTHS)
    broken = MONTHS[7]
    for table in ("lms", "financials"):
        for file in (tmp_path / "root" / "bronze" / table / f"snapshot_date={broken}").glob("*.parquet"):
            file.write_bytes(b"this is no parquet file")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    for table, n in (("lms", 24), ("financials", 18)):
        bad = medallion.write_silver(spark, table, f"{root}/bronze", f"{root}/silver", MONTHS)
        assert list(bad) == [broken] and bad[broken]
        reasons = medallion.quarantined(spark, "silver", table, bad)
        log = medallion.layer_partition_log(spark, "silver", f"{root}/silver", [table], MONTHS, reasons=reasons)
        found = statuses(log, table)
        assert found["silver", broken] == "failed" and sum(s == "processed" for s in found.values()) == n - 1
        error = log.filter(f"table_name = '{table}' and snapshot_date = '{broken}'").first()["error"]
        assert error == bad[broken]


def test_resume_touches_failed_dates_only(spark, run, tmp_path, monkeypatch):
    files, root = run[0], str(tmp_path / "root")
    real, broken = medallion.write_bronze, MONTHS[7]

    def spoilt(spark, table, *rest):
        done = real(spark, table, *rest)
        if table in ("lms", "financials"):
            for file in (tmp_path / "root" / "bronze" / table / f"snapshot_date={broken}").glob("*.parquet"):
                file.write_bytes(b"this is no parquet file")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        return done

    monkeypatch.setattr(medallion, "write_bronze", spoilt)
    log, failures = medallion.process_layers(spark, files, root, "first", MONTHS)
    monkeypatch.setattr(medallion, "write_bronze", real)
    assert statuses(log, "lms")["bronze", broken] == statuses(log, "lms")["silver", broken] == "failed"
    assert any(broken in f for f in failures)
    before = {t: written_files(root, t) for t in ("lms", "financials", "loan_type", "attributes")}
    again, failures = medallion.process_layers(spark, files, root, "second", MONTHS, resume=True)
    assert failures == []
    assert statuses(again, "lms")["bronze", broken] == statuses(again, "lms")["silver", broken] == "processed"
    for t, old in before.items():
        new = written_files(root, t)
        fresh = {p for p in new if new[p] != old.get(p)}
        assert set(old) <= set(new) and all(broken in p for p in fresh) and bool(fresh) == (t != "attributes"), t
    history = medallion.run_history(spark, root)
    touched = history.filter("run_id = 'second' and status = 'processed'").select("layer", "table_name", F.col("snapshot_date").cast("string")).collect()
    assert {tuple(r) for r in touched} == {(a, t, broken) for a in ("bronze", "silver") for t in ("lms", "financials")}
    assert spark.read.parquet(f"{root}/quarantine").filter("run_id = 'first'").count() >= 2
    whole = read_partitions(spark, f"{run[1]}/silver/loan_type")
    resumed = read_partitions(spark, f"{root}/silver/loan_type")
    assert sorted(map(tuple, resumed.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_a_new_loan_type_on_resume_rewrites_all_dates(spark, run, tmp_path):
    files, root = run[0], str(tmp_path / "root")
    medallion.write_bronze(spark, "financials", files["financials"], f"{root}/bronze", MONTHS)
    medallion.write_silver(spark, "financials", f"{root}/bronze", f"{root}/silver", MONTHS)
    old = set(read_partitions(spark, f"{root}/silver/loan_type").columns)
    day = read_partitions(spark, f"{root}/bronze/financials", dates=[MONTHS[2]])
    from featuremart.sources.tables import write_partitions

    new = day.withColumn("type_of_loan", F.lit("Boat Loan, and Auto Loan")).collect()
    write_partitions(spark.createDataFrame(new, day.schema), f"{root}/bronze/financials", dates=[MONTHS[2]])
    assert medallion.write_silver(spark, "financials", f"{root}/bronze", f"{root}/silver", [MONTHS[2]]) == {}
    types = read_partitions(spark, f"{root}/silver/loan_type")
    assert set(types.columns) - old == {"boat_loan"}
    assert types.filter("boat_loan is null").count() == 0 and types.filter("boat_loan = 1").count() == len(new)


def test_repeated_labels_are_merged_and_named(spark, run, tmp_path):
    import csv

    files, root = dict(run[0]), str(tmp_path / "root")
    with open(files["lms"]) as f:
        lines = list(csv.reader(f))
    twice = [r for r in lines[1:] if r[4] == "6"][:3]
    assert len(twice) == 3
    files["lms"] = str(tmp_path / "lms.csv")
    with open(files["lms"], "w", newline="") as f:
        csv.writer(f).writerows([*lines, *twice])
    summary = medallion.run_all(spark, files, root, "r", grid=GRID, baseline_params={"n_estimators": 3, "max_depth": 2}).first()
    assert "labels: 3 rows merged, 0 loans with differing rows" in summary["issues"]
    assert summary["model_training"]["model_saved"]
