"""Training, scoring and what is kept of a run."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scores import predicted_class
from ..operators import boosting
from ..operators.boosting import FEATURES, LABEL, SCORE
from ..operators.metrics import best_threshold, class_report, confusion, roc_auc, threshold_curve, with_rates
from ..operators.schema import feature_columns, quoted
from ..operators.scaling import fit_scaler, scale
from ..operators.splits import TimeWindows, stratified_split, time_split
from ..sources.scratch import cut
from ..sources.tables import SNAPSHOT
from .gold import LABEL_MOB

ID_COLUMNS = ("customer_id", SNAPSHOT, "loan_id", "label_date", LABEL, "label_def", "window", "split")

# Fixed value: a small grid over parameters that Spark's trees have.
SMALL_GRID = {"n_estimators": [50, 100], "max_depth": [4, 6], "learning_rate": [0.05, 0.1]}


def resolve_labels(labels: DataFrame) -> DataFrame:
    """One label row for each loan: the earliest dated one, as later rows restate what was known by then;
    of several rows on that date the worst label, and the smallest values of the other columns.

    An aggregate by loan, combined on the map side, so a loan with very many rows costs no more. Rows
    without a loan id belong to no loan and are left out; :func:`label_merges` counts all of this.
    """
    rest = [quoted(c) for c in labels.columns if c not in ("loan_id", SNAPSHOT, LABEL)]
    day, label = F.col(SNAPSHOT), F.col(LABEL)
    order = F.struct(day.isNull().alias("_undated"), day, label.isNull().alias("_unknown"), (-label).alias("_better"), *rest)
    first = labels.filter(F.col("loan_id").isNotNull()).groupBy("loan_id").agg(F.min(order).alias("_first"))
    of = {"loan_id": F.col("loan_id"), LABEL: (-F.col("_first._better")).cast(labels.schema[LABEL].dataType)}
    return first.select(*[of.get(c, F.col("_first")[c]).alias(c) for c in labels.columns])


def label_merges(labels: DataFrame) -> DataFrame:
    """One row on what :func:`resolve_labels` does: label rows, loans, rows merged into others, loans whose
    rows differ in date or label, and rows without a loan."""
    loan = F.col("loan_id").isNotNull()
    said = F.struct(F.col(SNAPSHOT).cast("string").alias("day"), F.col(LABEL).alias("label"))
    per_loan = labels.groupBy("loan_id").agg(F.count(F.lit(1)).alias("n"), (F.min(said) != F.max(said)).alias("differ"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_loan.agg(
        total("n").alias("label_rows"),
        F.count_if(loan).alias("loans"),
        total(F.when(loan, F.col("n") - 1)).alias("merged_rows"),
        F.count_if(loan & F.col("differ")).alias("differing_loans"),
        total(F.when(~loan, F.col("n"))).alias("rows_without_loan"),
    )


def labelled_rows(
    features: DataFrame, labels: DataFrame, windows: TimeWindows, mob: int = LABEL_MOB
) -> DataFrame:
    """One row per loan: its label, label date and window ('train', 'oot', 'none'), and the customer's
    latest features at or before the loan's start, ``mob`` months before the label's date.

    A loan with several label rows takes the one that :func:`resolve_labels` picks. The label's date
    decides the window. A row dated on the training date itself lies in neither. A loan
    whose customer has no features by its start gives no row; :func:`pairing_counts` counts them.

    Which snapshot a loan takes is found on distinct (customer, day) pairs, so neither features nor loans
    are paired with all the others of a customer.
    """
    dated = resolve_labels(labels).select(
        "customer_id",
        "loan_id",
        LABEL,
        F.col(SNAPSHOT).alias("label_date"),
        F.add_months(F.col(SNAPSHOT), -mob).alias("_start"),
    )
    days = (
        features.select("customer_id", F.col(SNAPSHOT).alias("_day"), F.col(SNAPSHOT).alias("_known"))
        .unionByName(dated.select("customer_id", F.col("_start").alias("_day")), allowMissingColumns=True)
        .groupBy("customer_id", "_day")
        .agg(F.max("_known").alias("_known"))
    )
    so_far = Window.partitionBy("customer_id").orderBy("_day")
    known = days.select("customer_id", F.col("_day").alias("_start"), F.max("_known").over(so_far).alias(SNAPSHOT))
    paired = dated.join(known, ["customer_id", "_start"]).drop("_start").join(features, ["customer_id", SNAPSHOT])
    ordered = paired.select(*[quoted(c) for c in features.columns], "loan_id", LABEL, "label_date")
    return time_split(ordered, "label_date", windows, "window")


def pairing_counts(features: DataFrame, labels: DataFrame, paired: DataFrame) -> dict:
    """What the gate before training looks at: loans, loans with features, keys that occur again, and what
    was merged to have one label for each loan."""

    def again(df: DataFrame, *keys: str) -> int:
        return df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]

    return {
        **label_merges(labels).first().asDict(),
        "paired": paired.count(),
        "repeated_features": again(features, "customer_id", SNAPSHOT),
        "repeated_loans": again(paired, "loan_id"),
    }


def check_pairing(counts: Mapping[str, int]) -> None:
    """Stop when a key repeats or nothing pairs: split sizes and labels would be wrong."""
    if counts["repeated_features"] or counts["repeated_loans"] or not counts["paired"]:
        raise ValueError(f"features and labels do not pair one to one: {dict(counts)}")


def merge_messages(counts: Mapping[str, int]) -> list[str]:
    """What the run's summary says about labels that were merged or left out."""
    found = []
    if counts["merged_rows"]:
        found.append(f"labels: {counts['merged_rows']} rows merged, {counts['differing_loans']} loans with differing rows")
    if counts["rows_without_loan"]:
        found.append(f"labels: {counts['rows_without_loan']} rows without a loan left out")
    return found


@dataclass
class TrainedRun:
    """What training leaves behind. Tables stay tables; the rest is a few numbers."""

    model: object
    scaler: DataFrame
    columns: list[str]
    threshold: float
    baseline_results: dict
    test_results: dict
    best_params: dict
    importance: DataFrame
    candidates: DataFrame
    report: DataFrame


def scaled_vectors(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The other columns plus the vector of scaled features."""
    rest = [quoted(c) for c in df.columns if c not in columns]
    return boosting.assemble(scale(df, scaler), columns).select(*rest, FEATURES)


def train_run(
    rows: DataFrame,
    grid: Mapping[str, Sequence] | None = None,
    key: str = "customer_id",
    label: str = LABEL,
    test_size: float = 0.2,
    val_size: float = 0.2,
    seed: int = 42,
    baseline_params: Mapping | None = None,
    id_columns: Sequence[str] = ID_COLUMNS,
    parallelism: int = 4,
) -> TrainedRun:
    """Split, scale, fit the baseline, search the grid, take the best model (fitted on the training
    rows only), choose the threshold on the validation rows, and evaluate on the test rows.

    ``key`` has to be unique per row. The split vectors are written to scratch once, as every fit
    reads them.
    """
    spark = rows.sparkSession
    columns = feature_columns(rows, tuple({*id_columns, key, label}))
    split = stratified_split(rows, key, label, test_size, val_size, seed)
    scaler = cut(fit_scaler(split.filter(F.col("split") == "train"), columns), "scaler")
    vectors = cut(scaled_vectors(split, scaler, columns), "training-vectors")
    train, val, test = (vectors.filter(F.col("split") == s) for s in ("train", "val", "test"))

    def scored(model, part):
        """Label and score, written: the metrics read them several times."""
        return cut(boosting.add_scores(model, part).select(label, SCORE), "scored")

    baseline = boosting.train(train, baseline_params, label)
    baseline_results = boosting.evaluate(scored(baseline, val), label=label).first().asDict()

    candidates, best_params, model = boosting.search(vectors, grid or SMALL_GRID, label, parallelism)

    threshold = best_threshold(threshold_curve(scored(model, val), SCORE, label)).first()["threshold"]
    test_scored = scored(model, test)
    judged = test_scored.withColumn("predicted", predicted_class(F.col(SCORE), threshold))
    return TrainedRun(
        model=model,
        scaler=scaler,
        columns=columns,
        threshold=threshold,
        baseline_results=baseline_results,
        test_results=boosting.evaluate(test_scored, threshold, label).first().asDict(),
        best_params=best_params,
        importance=boosting.feature_importance(spark, model, columns),
        candidates=candidates,
        report=class_report(judged, label, "predicted"),
    )


def run_results(spark: SparkSession, run: TrainedRun, run_id: str, path: str) -> DataFrame:
    """One nested row with the results of a training run."""
    rows = [
        (
            run_id,
            run.threshold,
            run.baseline_results,
            run.test_results,
            {k: str(v) for k, v in run.best_params.items()},
            [tuple(r) for r in run.importance.collect()],
            run.columns,
            path,
        )
    ]
    metrics = "struct<f1_score:double,f15_score:double,auc_score:double,threshold:double>"
    return spark.createDataFrame(
        rows,
        f"run_id string, optimal_threshold double, baseline_results {metrics}, test_results {metrics}, "
        "best_params map<string,string>, feature_importance array<struct<feature:string,importance:double>>, "
        "columns array<string>, model_directory string",
    )


def save_run(spark: SparkSession, run: TrainedRun, run_id: str, root: str, oot: DataFrame | None = None) -> str:
    """Keep model, scaler, results, grid, class report and out-of-time rows below ``root/run_<run_id>``."""
    path = f"{root}/run_{run_id}"
    boosting.save_model(run.model, f"{path}/model")
    run.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    run.candidates.write.mode("overwrite").parquet(f"{path}/candidates")
    run.report.write.mode("overwrite").parquet(f"{path}/class_report")
    run_results(spark, run, run_id, path).write.mode("overwrite").json(f"{path}/results")
    if oot is not None:
        oot.write.mode("overwrite").parquet(f"{path}/oot")
    return path


@dataclass
class SavedRun:
    model: object
    scaler: DataFrame
    columns: list[str]
    threshold: float
    results: dict
    oot: DataFrame | None


def load_run(spark: SparkSession, path: str, with_oot: bool = True) -> SavedRun:
    results = json.loads(spark.read.text(f"{path}/results").first()["value"])
    return SavedRun(
        model=boosting.load_model(f"{path}/model"),
        scaler=spark.read.parquet(f"{path}/scaler"),
        columns=results["columns"],
        threshold=results["optimal_threshold"],
        results=results,
        oot=spark.read.parquet(f"{path}/oot") if with_oot else None,
    )


def score_rows(
    run: SavedRun | TrainedRun,
    rows: DataFrame,
    run_id: str,
    ids: Sequence[str] = ("customer_id", SNAPSHOT),
    label: str | None = LABEL,
    timestamp: str | None = None,
) -> DataFrame:
    """Predictions with ids, threshold, run id, time and, when known, the actual label."""
    scored = boosting.add_scores(run.model, scaled_vectors(rows, run.scaler, run.columns))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if timestamp is None else F.lit(timestamp)
    actual = [quoted(label).cast("int").alias("actual_label")] if label and label in rows.columns else []
    return scored.select(
        predicted_class(F.col(SCORE), run.threshold).alias("prediction_binary"),
        F.col(SCORE),
        F.lit(run.threshold).alias("threshold_used"),
        F.lit(run_id).alias("model_run_id"),
        now.alias("prediction_timestamp"),
        *[quoted(c) for c in ids if c in rows.columns],
        *actual,
    )


def write_predictions(predictions: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Overwrite the partition of this run id only."""
    writer = (
        predictions.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_run_id")
        .format(fmt)
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(root)


def evaluate_predictions(predictions: DataFrame) -> DataFrame:
    """Out-of-time F1, F1.5 and AUC of scored rows."""
    rates = with_rates(confusion(predictions, "actual_label", "prediction_binary"))
    return rates.select(
        F.col("f1_score").alias("oot_f1"),
        F.col("f15_score").alias("oot_f15"),
        roc_auc(predictions, SCORE, "actual_label").scalar().alias("oot_auc"),
    )
