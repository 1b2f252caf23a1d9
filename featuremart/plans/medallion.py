"""The whole run: raw tables to bronze, silver, gold, model, predictions, report and summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import lower_columns
from ..operators.splits import TimeWindows
from ..sources.quarantine import process_good, quarantined, reason_of
from ..sources.scratch import cut, path_exists, remove_path, scratch_scope
from ..sources.spine import spine_between
from ..sources.tables import (
    MALFORMED,
    SNAPSHOT,
    observed,
    partition_counts,
    partition_values,
    read_dates,
    read_raw_rows,
    reject_reason,
    slice_snapshots,
    union_all,
    write_partitions,
)
from .gold import write_gold
from .monitoring import METRICS, monitoring_report, store_metrics, stored_metrics, write_report
from .runlog import LOG_COLUMNS, append_log, latest_status, partition_log, pending, run_summary
from .silver import write_silver
from .training import (
    check_pairing,
    evaluate_predictions,
    labelled_rows,
    load_run,
    merge_messages,
    pairing_counts,
    save_run,
    score_rows,
    train_run,
    write_predictions,
)

TABLES = ("clickstream", "attributes", "financials", "lms")


@dataclass
class RunPaths:
    bronze: str
    silver: str
    gold: str
    models: str
    predictions: str

    @classmethod
    def below(cls, root: str) -> "RunPaths":
        return cls(*(f"{root}/{x}" for x in ("bronze", "silver", "gold", "models", "predictions")))


def spine_dates(spark: SparkSession, start: str, end: str) -> list[str]:
    """First-of-month dates as text. One value per month."""
    return [r[0] for r in spine_between(spark, start, end).select(F.col(SNAPSHOT).cast("string")).collect()]


def write_bronze(
    spark: SparkSession,
    table: str,
    source: str,
    bronze_root: str,
    dates: Sequence[str],
    fmt: str = "parquet",
    content: bool = False,
) -> int:
    """Slice one raw table into all its snapshot partitions with a single scan.

    Returns the number of rows that belong to no partition: lines that don't fit the header, and rows
    without a readable snapshot date. They are seen during that scan; if there are any, a second one writes
    them to ``<bronze_root>_rejects/<table>`` with their ``reason``.
    """
    raw = lower_columns(read_raw_rows(spark, source))
    seen, reason = Observation(), reject_reason()
    rows = raw.observe(seen, F.count_if(reason.isNotNull()).alias("rejected"))
    good = rows.filter(reason.isNull()).drop(MALFORMED)
    write_partitions(slice_snapshots(good, dates), f"{bronze_root}/{table}", fmt=fmt, dates=dates, content=content)
    rejects = f"{bronze_root}_rejects/{table}"
    found = observed(seen)
    if not (found["rejected"] if found else raw.filter(reason.isNotNull()).count()):
        remove_path(spark, rejects)
        return 0
    raw.withColumn("reason", reason).filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(rejects)
    return spark.read.parquet(rejects).count()


def rejected_reasons(spark: SparkSession, bronze_root: str, table: str) -> list[str]:
    """What the summary says about a table's rejected rows: one line for each reason."""
    rows = spark.read.parquet(f"{bronze_root}_rejects/{table}").groupBy("reason").count().orderBy("reason")
    said = {"malformed row": "malformed rows", "unreadable snapshot date": "rows without a readable snapshot date"}
    return [f"bronze {table}: {r['count']} {said[r['reason']]}" for r in rows.collect()]


def expected_dates(spark: SparkSession, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, snapshot_date) of the wanted dates of each table."""
    rows = [(t, d) for t, days in wanted.items() for d in days]
    return spark.createDataFrame(rows, "table_name string, day string").selectExpr("table_name", f"CAST(day AS DATE) AS {SNAPSHOT}")


def layer_partition_log(
    spark: SparkSession,
    layer: str,
    root: str,
    tables: Sequence[str],
    dates: Sequence[str],
    fmt: str = "parquet",
    expected: DataFrame | None = None,
    reasons: DataFrame | None = None,
) -> DataFrame:
    """Run log of one layer from the partitions found on disk, for all tables and dates or the ``expected``
    ones. A partition that ``reasons`` names is not opened."""
    if expected is None:
        expected = expected_dates(spark, {t: dates for t in TABLES})
    if reasons is None:
        reasons = quarantined(spark, layer, "", {})
    bad = {(r["table_name"], str(r[SNAPSHOT])) for r in reasons.collect()}
    rows = []
    for t in tables:
        there = [d for d in partition_values(spark, f"{root}/{t}") if d in set(dates) and (t, d) not in bad]
        found, unreadable = _counted(spark, f"{root}/{t}", there, fmt)
        rows += [(t, d, n) for d, n in found.items()]
        reasons = reasons.unionByName(quarantined(spark, layer, t, unreadable))
    counts = spark.createDataFrame(rows, "table_name string, day string, rows long")
    counts = counts.selectExpr("table_name", f"CAST(day AS DATE) AS {SNAPSHOT}", "rows")
    return partition_log(expected, counts, layer, reasons)


def _counted(spark: SparkSession, path: str, dates: Sequence[str], fmt: str) -> tuple[dict[str, int], dict[str, str]]:
    """Rows of each date, and reasons for those that can't be read. One number for each date."""
    found: dict[str, int] = {}

    def count(own: Sequence[str]) -> None:
        found.clear()
        found.update((str(r[SNAPSHOT]), r["rows"]) for r in partition_counts(read_dates(spark, path, own, fmt)).collect())

    try:
        return found, process_good(dates, count, count) if dates else {}
    except Exception as error:  # no date can be read
        return {}, dict.fromkeys(dates, reason_of(error))


def run_history(spark: SparkSession, root: str) -> DataFrame | None:
    """The log of all attempts below a root, if there is one."""
    path = f"{root}/run_log"
    if not path_exists(spark, path):
        return None
    return spark.read.schema(f"run_id string, attempt int, layer string, table_name string, {SNAPSHOT} date, rows long, status string, error string").parquet(path)


def process_layers(
    spark: SparkSession,
    sources: Mapping[str, str],
    root: str,
    run_id: str,
    dates: Sequence[str],
    bronze_format: str = "parquet",
    resume: bool = False,
    content: bool = True,
) -> tuple[DataFrame, list[str]]:
    """Bronze and silver of all tables: the log of the last attempt at each partition, and messages.

    A table without a source, or one that fails, is logged and the others go on. A date that fails is set
    aside in ``<root>/quarantine`` with its reason, and the table's other dates go on. Every attempt is
    added to ``<root>/run_log``. ``resume`` takes up only partitions whose last attempt failed or that had
    none, and silver partitions whose bronze was written again; ``content`` compares checksums after each
    write.
    """
    paths = RunPaths.below(root)
    failures = [f"bronze {t}: no source" for t in TABLES if t not in sources]
    history = run_history(spark, root)
    attempt = 1 + ((history.agg(F.max("attempt")).first()[0] or 0) if history is not None else 0)

    def todo(layer: str, expected: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
        if not resume or history is None:
            return {t: list(days) for t, days in expected.items()}
        left = pending(expected_dates(spark, expected), history, layer).collect()
        return {t: sorted(str(r[SNAPSHOT]) for r in left if r["table_name"] == t) for t in expected}

    def work(layer: str, table: str, days: Sequence[str], action) -> tuple[object, dict[str, str]]:
        """The action's result and the bad dates; all of them if it fails as a whole."""
        try:
            return action(), {}
        except Exception as error:  # whatever it is, it is reported and the run goes on
            failures.append(f"{layer} {table}: {reason_of(error)}")
            return None, dict.fromkeys(days, reason_of(error))

    def logged(layer: str, place: str, tables: Sequence[str], wanted: Mapping[str, Sequence[str]], fmt: str, bad) -> None:
        reasons = union_all(quarantined(spark, layer, "", {}), *[quarantined(spark, layer, t, b) for t, b in bad.items() if b])
        found = layer_partition_log(spark, layer, place, tables, dates, fmt, expected_dates(spark, wanted), reasons)
        path = f"{root}/logs/{layer}_{run_id}"
        found.write.mode("overwrite").parquet(path)
        written = spark.read.schema(found.schema).parquet(path)
        append_log(written, f"{root}/run_log", run_id, attempt)
        apart = written.filter((F.col("status") == "failed") & ~F.col("error").startswith("no rows in "))
        if not apart.isEmpty():
            append_log(apart, f"{root}/quarantine", run_id, attempt)

    present = [t for t in TABLES if t in sources]
    wanted = todo("bronze", {t: dates for t in TABLES})
    bad = {}
    for t in present:
        if wanted[t]:
            write = lambda: write_bronze(spark, t, sources[t], paths.bronze, wanted[t], bronze_format, content)  # noqa: B023, E731
            rejected, bad[t] = work("bronze", t, wanted[t], write)
            failures.extend(rejected_reasons(spark, paths.bronze, t) if rejected else [])
    logged("bronze", paths.bronze, present, wanted, bronze_format, bad)

    state = latest_status(run_history(spark, root)).filter(F.col(SNAPSHOT).cast("string").isin(list(dates)))
    done = state.filter("layer = 'bronze' AND status = 'processed'").select("table_name").distinct()
    usable = [t for t in present if t in {r[0] for r in done.collect()}]
    again = todo("silver", {t: dates for t in usable})
    days = {t: sorted({*again[t], *wanted[t]}) for t in usable}
    expected = {t: days.get(t, list(dates)) for t in TABLES}
    bad = {}
    for t in usable:
        if days[t]:
            write = lambda: write_silver(spark, t, paths.bronze, paths.silver, days[t], bronze_format, content)  # noqa: B023, E731
            apart, whole = work("silver", t, days[t], write)
            bad[t] = apart or whole
            failures.extend(f"silver {t}: {d} set aside: {why}" for d, why in sorted((apart or {}).items()))
    logged("silver", paths.silver, usable, expected, "parquet", bad)
    state = latest_status(run_history(spark, root)).filter(F.col(SNAPSHOT).cast("string").isin(list(dates)))
    return state.select(*LOG_COLUMNS), failures


def run_all(
    spark: SparkSession,
    sources: Mapping[str, str],
    root: str,
    run_id: str,
    start: str = "2023-01-01",
    end: str = "2024-12-01",
    train_date: date = date(2025, 1, 1),
    train_months: int = 12,
    oot_months: int = 3,
    grid: Mapping[str, Sequence] | None = None,
    baseline_params: Mapping | None = None,
    fit_on: str = "train",
    bronze_format: str = "parquet",
    resume: bool = False,
    content: bool = True,
) -> DataFrame:
    """Run every step and return the summary row. A table without a source, a table or a date that fails is
    logged and the run goes on with the others; so it does when a later step fails. Logs are written before
    the next step begins, the summary in any case, with a message for each failure among its issues.
    ``resume`` leaves bronze and silver partitions that an earlier run has processed as they are.

    ``fit_on='train'`` learns means and categories from customers labelled up to the end of the
    training window; ``'all'`` learns them from every row.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    paths = RunPaths.below(root)
    dates = spine_dates(spark, start, end)
    windows = TimeWindows.before(train_date, train_months, oot_months)
    log, failures = process_layers(spark, sources, root, run_id, dates, bronze_format, resume, content)

    def attempt(step: str, action, *args):
        """The step's result, or None and a message."""
        try:
            return action(*args)
        except Exception as error:  # whatever it is, it is reported and the run goes on
            failures.append(f"{step}: {reason_of(error)}")
            return None

    fit_until = windows.train_end.isoformat() if fit_on == "train" else None
    gold = attempt("gold", write_gold, spark, paths.silver, paths.gold, dates, fit_until)
    features, labels = gold or (spark.createDataFrame([], "customer_id string"),) * 2

    def train() -> str:
        with scratch_scope(spark):
            rows = cut(labelled_rows(features, labels, windows), "labelled-rows")
            counts = pairing_counts(features, labels, rows)
            failures.extend(merge_messages(counts))
            check_pairing(counts)
            oot = rows.filter(F.col("window") == "oot")
            trained = train_run(
                rows.filter(F.col("window") == "train"), grid, key="loan_id", baseline_params=baseline_params
            )
            auc = float(trained.test_results["auc_score"]) if trained.test_results["auc_score"] is not None else None
            store_metrics(spark.createDataFrame([("training", run_id, run_id, auc)], METRICS), f"{root}/metrics")
            return save_run(spark, trained, run_id, paths.models, oot)

    def score() -> DataFrame:
        saved = load_run(spark, model_path)
        scored = score_rows(saved, saved.oot, run_id)
        write_predictions(scored, paths.predictions)
        written = spark.read.schema(scored.schema).parquet(paths.predictions)
        return written.filter(F.col("model_run_id") == run_id)

    def monitor() -> DataFrame:
        path = f"{paths.predictions}_reports/monitoring_{run_id}"
        trained = stored_metrics(spark, f"{root}/metrics").filter((F.col("kind") == "training") & (F.col("run_id") == run_id))
        report = cut(monitoring_report(scores, trained.select("auc").scalar()), "report")
        write_report(report, path)
        row = report.select(F.lit("monitoring").alias("kind"), F.lit(run_id).alias("run_id"), "run_id", F.col("auc_score").alias("auc"))
        store_metrics(row.toDF("kind", "run_id", "model_run_id", "auc"), f"{root}/metrics")
        return report

    model_path = attempt("training", train) if gold else None
    scores = attempt("scoring", score) if model_path else None
    report = attempt("monitoring", monitor) if scores else None
    evaluation = attempt("evaluation", evaluate_predictions, scores) if scores else None
    summary = run_summary(
        spark, log, features, labels, run_id, model_path, evaluation, report,
        failures=failures, gold_status="completed" if gold else "failed",
    )
    summary = cut(summary, "summary")
    write_report(summary, f"{paths.predictions}_reports/summary_{run_id}")
    return summary
