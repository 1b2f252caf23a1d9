"""Metrics against brute force and against Spark's evaluator."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from featuremart.operators import metrics, profiling
from featuremart.functions.scores import ThresholdGrid


def sample(n=600, seed=1, digits=None):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        y = int(rnd.random() < 0.3)
        # A third of the rows share one score.
        s = 0.25 if rnd.random() < 0.33 else min(max(rnd.gauss(0.35 + 0.2 * y, 0.2), 0.0), 1.0)
        out.append((f"g{i % 3}", y, round(s, digits) if digits is not None else s))
    return out


def pairs_auc(data):
    pos = [s for _, y, s in data if y == 1]
    neg = [s for _, y, s in data if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [None, 1])
@pytest.mark.parametrize("buckets", [1024, 10, 2])
def test_auc(spark, digits, buckets):
    data = sample(digits=digits)
    df = spark.createDataFrame(data, "g string, y int, s double").repartition(4)
    got = metrics.roc_auc(df, "s", "y", buckets=buckets).first()["auc"]
    assert got == pytest.approx(pairs_auc(data), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert got == pytest.approx(evaluator.evaluate(df), abs=1e-12)
    for r in metrics.roc_auc(df, "s", "y", ["g"], buckets).collect():
        assert r["auc"] == pytest.approx(pairs_auc([x for x in data if x[0] == r["g"]]), abs=1e-12)


def test_auc_without_a_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, s double")
    assert metrics.roc_auc(df, "s", "y").first()["auc"] is None


def f1(data, t):
    tp = sum(y == 1 and s > t for _, y, s in data)
    wrong = sum((y == 1) != (s > t) for _, y, s in data)
    return 2 * tp / (2 * tp + wrong) if tp else 0.0


def test_threshold_curve_and_best(spark):
    data = sample()
    df = spark.createDataFrame(data, "g string, y int, s double")
    curve = metrics.threshold_curve(df, "s", "y")
    got = {r["index"]: r["f1_score"] for r in curve.collect()}
    want = {i: f1(data, t) for i, t in enumerate(ThresholdGrid().values())}
    assert got == pytest.approx(want)
    best = metrics.best_threshold(curve).first()
    first = max(want, key=lambda i: (want[i], -i))
    assert best["threshold"] == ThresholdGrid().values()[first]


def test_best_threshold_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(1, 0.95), (0, 0.05)], "y int, s double")
    assert metrics.best_threshold(metrics.threshold_curve(df, "s", "y")).first()["threshold"] == 0.1


def test_confusion_counts_sum_to_the_rows(spark):
    df = spark.createDataFrame(sample(), "g string, y int, s double").withColumn("p", (F.col("s") > 0.4).cast("int"))
    for r in metrics.confusion(df, "y", "p", ["g"]).collect():
        assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == 200


def test_class_report(spark):
    data = [(0, 0)] * 50 + [(0, 1)] * 10 + [(1, 0)] * 5 + [(1, 1)] * 35
    report = {r["class"]: r for r in metrics.class_report(spark.createDataFrame(data, "y int, p int"), "y", "p").collect()}
    assert report["0"]["precision"] == pytest.approx(50 / 55) and report["0"]["recall"] == pytest.approx(50 / 60)
    assert report["1"]["precision"] == pytest.approx(35 / 45) and report["1"]["recall"] == pytest.approx(35 / 40)
    assert report["accuracy"]["f1_score"] == pytest.approx(0.85) and report["accuracy"]["precision"] is None
    f0, f1_ = report["0"]["f1_score"], report["1"]["f1_score"]
    assert report["macro avg"]["f1_score"] == pytest.approx((f0 + f1_) / 2)
    assert report["weighted avg"]["f1_score"] == pytest.approx(0.6 * f0 + 0.4 * f1_)
    assert {r["support"] for c, r in report.items() if c.endswith("avg") or c == "accuracy"} == {100}


def test_profiles(spark):
    df = spark.createDataFrame([(1, 0.995, None), (0, 0.005, "x"), (0, 0.5, None)], "p int, s double, c string")
    totals = profiling.score_totals(df, "s", "p").first()
    assert (totals["total_predictions"], totals["positive_predictions"]) == (3, 1)
    assert (totals["very_low"], totals["very_high"]) == (1, 1)
    assert totals["positive_rate"] == pytest.approx(1 / 3) and totals["avg_prediction_proba"] == pytest.approx(0.5)
    assert [tuple(r) for r in profiling.missing_counts(df).collect()] == [("c", 2)]
    shape = profiling.table_shape(df).first()
    assert (shape["row_count"], shape["column_count"]) == (3, 3)


def test_approximate_percentiles_are_close(spark):
    df = spark.range(10_001).select((F.col("id") / 10_000).alias("s"))
    exact = profiling.score_percentiles(df, "s").first()
    near = profiling.score_percentiles(df, "s", approximate=True).first()
    for p in profiling.PERCENTS:
        assert exact[f"p{p}"] == pytest.approx(p / 100) and abs(near[f"p{p}"] - p / 100) < 1e-3
