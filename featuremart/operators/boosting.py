"""Gradient-boosted trees: parameters, training, grid search, importance, persistence."""

from __future__ import annotations

import itertools
import json
import logging
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import predicted_class
from .metrics import confusion, roc_auc, with_rates
from .schema import quoted

log = logging.getLogger(__name__)

# The starting parameters and the search grid, under their usual boosting names.
BASELINE = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "random_state": 42}
FULL_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [4, 6, 8],
    "learning_rate": [0.05, 0.1, 0.15],
    "subsample": [0.8, 0.9],
    "colsample_bytree": [0.8, 0.9],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 2, 5],
    "min_child_weight": [1, 3, 5],
}

# Usual name -> (Spark parameter, conversion). The regularisation weights have no counterpart.
SPARK_PARAMS = {
    "n_estimators": ("maxIter", int),
    "max_depth": ("maxDepth", int),
    "learning_rate": ("stepSize", float),
    "subsample": ("subsamplingRate", float),
    "colsample_bytree": ("featureSubsetStrategy", lambda x: "all" if float(x) >= 1 else str(float(x))),
    "min_child_weight": ("minInstancesPerNode", int),
    "random_state": ("seed", int),
}

FEATURES, LABEL, SCORE = "features", "label", "prediction_proba"


def supported(params: Mapping) -> dict:
    """The parameters Spark's trees know; the others are named in a warning and left out."""
    unknown = sorted(set(params) - set(SPARK_PARAMS))
    if unknown:
        log.warning("no counterpart in Spark's boosted trees, left out: %s", ", ".join(unknown))
    return {k: v for k, v in params.items() if k in SPARK_PARAMS}


def classifier(params: Mapping | None = None, label: str = LABEL) -> GBTClassifier:
    """Boosted trees with the baseline parameters, overridden by ``params``."""
    merged = {**BASELINE, **supported(params or {})}
    spark_params = {SPARK_PARAMS[k][0]: SPARK_PARAMS[k][1](v) for k, v in merged.items()}
    return GBTClassifier(featuresCol=FEATURES, labelCol=label, lossType="logistic", **spark_params)


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the feature vector. Nulls must have been imputed: a null is an error, not a value."""
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)


def train(df: DataFrame, params: Mapping | None = None, label: str = LABEL):
    return classifier(params, label).fit(df)


def add_scores(model, df: DataFrame) -> DataFrame:
    """Add the probability of class 1; the model's own output columns are dropped."""
    scored = model.transform(df).withColumn(SCORE, vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction")


def prefix_scores(model, df: DataFrame, counts: Sequence[int]) -> DataFrame:
    """Each row once for every one of ``counts``, in column ``n_estimators``, with the score of the model's first
    trees alone. Boosting adds trees one by one, so these are the scores of a model fitted with that many.

    The model gives each row's leaf of every tree; the leaves' values are looked up and added.
    """
    leaves = [
        [weight * float(x) for x in re.findall(r"Predict: (\S+)", tree.toDebugString)]
        for tree, weight in zip(model.trees, model.treeWeights, strict=True)
    ]
    values = F.from_json(F.lit(json.dumps(leaves)), "array<array<double>>")
    steps = F.transform(
        vector_to_array("_leaves"), lambda leaf, i: F.get(F.get(values, i.cast("int")), leaf.cast("int"))
    )
    sums = [
        F.struct(
            F.lit(n).alias("n_estimators"),
            F.aggregate(F.slice("_steps", 1, n), F.lit(0.0), lambda a, x: a + x).alias("margin"),
        )
        for n in counts
    ]
    placed = model.transform(df, {model.leafCol: "_leaves"}).select(*[quoted(c) for c in df.columns], steps.alias("_steps"))
    each = placed.withColumn("_sum", F.explode(F.array(*sums)))
    score = 1 / (1 + F.exp(-2 * F.col("_sum.margin")))
    return each.select(*[quoted(c) for c in df.columns], "_sum.n_estimators", score.alias(SCORE))


def evaluate(scored: DataFrame, threshold: float = 0.5, label: str = LABEL) -> DataFrame:
    """One row: f1_score, f15_score, auc_score, threshold."""
    judged = scored.withColumn("_predicted", predicted_class(F.col(SCORE), threshold))
    rates = with_rates(confusion(judged, label, "_predicted"))
    return rates.select(
        "f1_score",
        "f15_score",
        roc_auc(scored, SCORE, label).scalar().alias("auc_score"),
        F.lit(float(threshold)).alias("threshold"),
    )


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations, keys in alphabetical order with the last key changing fastest."""
    keys = sorted(grid)
    return [dict(zip(keys, values)) for values in itertools.product(*(grid[k] for k in keys))]


class SearchResult(NamedTuple):
    """All candidates with their scores, and the best of them."""

    candidates: DataFrame
    best_params: dict
    best_model: object


def search(
    rows: DataFrame,
    grid: Mapping[str, Sequence],
    label: str = LABEL,
    parallelism: int = 4,
    split: str = "split",
) -> SearchResult:
    """Fit every grid point on the rows of split 'train' and score F1 at 0.5 on 'train' and 'val'.

    The candidates table has one row per grid point: candidate, params, train_f1, val_f1. The highest
    validation F1 wins, the first among equals. Its model is fitted on the training rows only and is
    handed back, so it need not be fitted again; the other models are let go.

    Points that differ in the number of trees only share one fit with the most trees, whose first trees are
    scored by themselves; a winner with fewer is fitted once more. Each fit is a set of Spark jobs; a few
    run at once, and both parts are scored in one pass. The rows are read once per fit, so hand in a
    written table.
    """
    usable = supported({k: None for k in grid})
    points = grid_points({k: grid[k] for k in usable})
    train_rows = rows.filter(F.col(split) == "train")
    judged_rows = rows.filter(F.col(split).isin("train", "val"))
    lock, best = Lock(), {}
    trees = [int(p.get("n_estimators", BASELINE["n_estimators"])) for p in points]
    alike: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        alike.setdefault(tuple((k, v) for k, v in p.items() if k != "n_estimators"), []).append(i)

    def run(own):
        most = max(own, key=lambda i: trees[i])
        model = train(train_rows, points[most], label)
        scored = prefix_scores(model, judged_rows, sorted({trees[i] for i in own}))
        judged = scored.withColumn("_predicted", predicted_class(F.col(SCORE), 0.5))
        keys = [split, "n_estimators"]
        rates = with_rates(confusion(judged, label, "_predicted", keys)).select(*keys, "f1_score").collect()
        f1 = {(r[split], r["n_estimators"]): r["f1_score"] for r in rates}
        first = max(own, key=lambda i: (f1.get(("val", trees[i]), -1.0), -i))
        rank = (f1.get(("val", trees[first]), -1.0), -first)
        with lock:
            if not best or rank > best["rank"]:
                best.update(rank=rank, model=model if trees[first] == trees[most] else None)
        return [(i, {k: str(v) for k, v in points[i].items()}, f1.get(("train", trees[i])), f1.get(("val", trees[i]))) for i in own]

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        table = sorted((row for part in pool.map(run, alike.values()) for row in part), key=lambda row: row[0])
    winner = points[-best["rank"][1]]
    model = best["model"] or train(train_rows, winner, label)
    candidates = rows.sparkSession.createDataFrame(
        table, "candidate int, params map<string,string>, train_f1 double, val_f1 double"
    )
    return SearchResult(candidates, winner, model)


def best_candidate(results: DataFrame) -> dict:
    """The winner's parameters from a kept candidates table."""
    row = results.orderBy(F.desc("val_f1"), F.asc("candidate")).first()
    convert = {"colsample_bytree": float}
    return {
        k: convert.get(k, SPARK_PARAMS[k][1])(float(v) if "." in v else int(v)) for k, v in row["params"].items()
    }


def feature_importance(spark, model, names: Sequence[str] | None = None, top_k: int | None = None) -> DataFrame:
    """(feature, importance), most important first; ``top_k`` keeps the first rows of that list.

    The model holds one number per feature, so the table is as small as the feature list.
    """
    weights = model.featureImportances.toArray().tolist()
    names = list(names) if names is not None else [f"feature_{i}" for i in range(len(weights))]
    if len(names) != len(weights):
        raise ValueError(f"{len(names)} names for {len(weights)} features")
    ranked = spark.createDataFrame(list(zip(names, weights)), "feature string, importance double").orderBy(
        F.desc("importance"), F.asc("feature")
    )
    return ranked if top_k is None else ranked.limit(top_k)


def save_model(model, path: str) -> None:
    PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str):
    return PipelineModel.load(path).stages[0]
