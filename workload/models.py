"""Training, scoring, grid search and importance on labelled documents. Trees have no SQL; what has to hold
whatever the trees say (ids, labels, the threshold rule, equal scores after reloading, the grid) has."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.operators import boosting
from featuremart.operators.encoding import fit_categories, one_hot
from featuremart.operators.schema import feature_columns
from featuremart.operators.splits import stratified_split
from featuremart.plans import training
from featuremart.sources.scratch import cut, scratch_dir

from .registry import Tables, query

SHORT = {"n_estimators": 5, "max_depth": 3}
FEATURES = ["n_chars", "words", "lines", "digits", "upper"]


def document_rows(t: Tables):
    """Numbers about the whole text of each labelled document."""
    text = F.col("text")
    return t.labels.join(t.documents, "doc_id").select(
        "doc_id",
        "lang",
        F.col("quality").alias("label"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.regexp_count(text, F.lit(r"\S+")).cast("double").alias("words"),
        F.regexp_count(text, F.lit("\n")).cast("double").alias("lines"),
        F.regexp_count(text, F.lit("[0-9]")).cast("double").alias("digits"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("double").alias("upper"),
    )


@query("gbt_train_score")
def gbt_train_score(t: Tables):
    """Train on a stratified part, keep the run, load it again, score every row, keep the predictions."""
    rows = document_rows(t)
    rows = cut(one_hot(rows, fit_categories(rows, ["lang"])), "documents")
    run = training.train_run(
        rows,
        {"n_estimators": [5], "max_depth": [3]},
        key="doc_id",
        baseline_params=SHORT,
    )
    path = training.save_run(t.spark, run, "documents", scratch_dir(t.spark, "models"), oot=rows)
    saved = training.load_run(t.spark, path)
    predictions = scratch_dir(t.spark, "predictions")
    training.write_predictions(
        training.score_rows(saved, saved.oot, "documents", ids=["doc_id"], timestamp="2025-01-01 00:00:00"), predictions
    )
    return t.spark.read.parquet(predictions)


def vectors(t: Tables):
    split = stratified_split(document_rows(t), "doc_id")
    return cut(boosting.assemble(split, FEATURES).select("label", "split", boosting.FEATURES), "vectors")


@query("grid_search")
def grid_search(t: Tables):
    grid = {"max_depth": [2, 3], "learning_rate": [0.1, 0.3], "n_estimators": [5]}
    return boosting.search(vectors(t), grid).candidates


@query("feature_importance_topk")
def feature_importance_topk(t: Tables):
    model = boosting.train(vectors(t).filter("split = 'train'"), SHORT)
    return boosting.feature_importance(t.spark, model, FEATURES, top_k=3)


@query(
    "prediction_contract",
    """
SELECT l.doc_id, quality AS actual_label, 'documents' AS model_run_id, true AS follows_threshold, true AS same_after_reload,
       n_chars > 1000 AS kept_for_later
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
)
def prediction_contract(t: Tables):
    """One run trained, kept and loaded again: every row is scored once, with its id and label; the class
    follows from score and threshold; the loaded model and scaler give the score of the trained ones; the
    rows kept beside the model come back."""
    rows = cut(document_rows(t).drop("lang"), "documents")
    run = training.train_run(rows, {"n_estimators": [3], "max_depth": [2]}, key="doc_id", baseline_params={"n_estimators": 2, "max_depth": 2})
    later = rows.filter("n_chars > 1000")
    saved = training.load_run(t.spark, training.save_run(t.spark, run, "documents", scratch_dir(t.spark, "models"), oot=later))
    path = scratch_dir(t.spark, "predictions")
    training.write_predictions(training.score_rows(saved, rows, "documents", ids=["doc_id"], timestamp="2025-01-01 00:00:00"), path)
    before = training.score_rows(run, rows, "documents", ids=["doc_id"]).select("doc_id", F.col(boosting.SCORE).alias("before"))
    later = saved.oot.select("doc_id", F.lit(True).alias("later"))
    written = t.spark.read.parquet(path).join(before, "doc_id").join(later, "doc_id", "left")
    judged = (F.col(boosting.SCORE) > F.col("threshold_used")).cast("int") == F.col("prediction_binary")
    return written.select(
        "doc_id",
        "actual_label",
        "model_run_id",
        judged.alias("follows_threshold"),
        (F.col(boosting.SCORE) == F.col("before")).alias("same_after_reload"),
        F.coalesce("later", F.lit(False)).alias("kept_for_later"),
    )


CANDIDATE_GRID = {"max_depth": [1, 2], "learning_rate": [0.1, 0.3], "n_estimators": [2], "reg_alpha": [0, 1]}


@query(
    "grid_contract",
    """
WITH c AS (SELECT row_number() OVER (ORDER BY lr, depth) - 1 AS i, lr, depth
           FROM (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE]) AS lr), (SELECT unnest([1, 2]) AS depth))
SELECT CAST(i AS INTEGER) AS candidate, lr AS learning_rate, depth AS max_depth, 2 AS n_estimators, true AS scored,
       true AS winner_by_rule FROM c""",
)
def grid_contract(t: Tables):
    """The grid's points in order, without the axis that Spark's trees lack; each scored on both parts; the
    winner has the highest validation score, the first of equals, and is fitted on the training rows only."""
    rows = vectors(t)
    found = boosting.search(rows, CANDIDATE_GRID)
    table = cut(found.candidates, "candidates")
    best = table.orderBy(F.desc("val_f1"), "candidate").first()["params"]
    by_rule = best == {k: str(v) for k, v in found.best_params.items()}
    own = boosting.train(rows.filter("split = 'train'"), found.best_params)
    same = own.toDebugString.split("\n", 1)[1] == found.best_model.toDebugString.split("\n", 1)[1]
    return table.select(
        "candidate",
        F.col("params.learning_rate").cast("double").alias("learning_rate"),
        F.col("params.max_depth").cast("int").alias("max_depth"),
        F.col("params.n_estimators").cast("int").alias("n_estimators"),
        (F.col("train_f1").between(0, 1) & F.col("val_f1").between(0, 1)).alias("scored"),
        F.lit(same and by_rule).alias("winner_by_rule"),
    )


@query(
    "importance_contract",
    """
SELECT f AS feature, true AS in_order, true AS within_total, true AS listed
FROM (SELECT unnest(['digits', 'lines', 'n_chars', 'upper', 'words']) AS f)""",
)
def importance_contract(t: Tables):
    """Every feature of the table without its ids once; weights fall and add up to one; the three first ones
    are the top-k report."""
    rows = cut(document_rows(t).drop("lang"), "documents")
    names = feature_columns(rows, ("doc_id", "label"))
    model = boosting.train(boosting.assemble(rows, names), SHORT)
    ranked = boosting.feature_importance(t.spark, model, names)
    top = [r["feature"] for r in boosting.feature_importance(t.spark, model, names, top_k=3).collect()]
    weights = F.col("all.importance")
    whole = ranked.agg(F.collect_list(F.struct("importance", "feature")).alias("all"))
    return whole.select(
        F.explode("all.feature").alias("feature"),
        (F.array_sort(weights) == F.reverse(weights)).alias("in_order"),
        (F.abs(F.aggregate(weights, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("within_total"),
        (F.slice("all.feature", 1, 3) == F.array(*map(F.lit, top))).alias("listed"),
    )
