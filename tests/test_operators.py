"""Operators against brute force on small tables, and their properties."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from featuremart.operators import boosting, clipping, encoding, imputation, pairing, quantiles, scaling, schema, splits, tokens
from featuremart.operators.pointintime import point_in_time_means

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- schema


def test_lower_columns_rejects_collisions(spark):
    assert schema.lower_columns(spark.createDataFrame([(1, 2)], "A int, B int")).columns == ["a", "b"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="case"):
            schema.lower_columns(spark.createDataFrame([(1, 2)], "a int, A int"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_declare_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="not found"):
        schema.declare(spark.createDataFrame([("1",)], "a string"), {"b": "int"})


def test_feature_columns_ignore_absent_ids(spark):
    df = spark.createDataFrame([("1", 2)], "customer_id string, x int")
    assert schema.feature_columns(df) == ["x"]


def test_fill_numeric_covers_every_numeric_column_by_default(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b double, s string")
    assert rows(schema.fill_numeric(df)) == [(0, 0.0, None)]
    assert rows(schema.fill_numeric(df, columns=["a"])) == [(0, None, None)]


# ---- quantiles and clipping


def disc(vals, q):
    vals = sorted(vals)
    return vals[max(math.ceil(q * len(vals)) - 1, 0)]


def linear(vals, p):
    vals = sorted(vals)
    at = p * (len(vals) - 1)
    low = math.floor(at)
    high = math.ceil(at)
    return vals[low] + (vals[high] - vals[low]) * (at - low)


@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_exact_quantiles_with_a_hot_group_and_ties(spark, accuracy):
    """A third of the rows in one group, and a value shared by a third of that group. The low accuracy
    makes the groups large enough for the brackets to cut."""
    rnd = random.Random(3)
    data = [("hot", float(rnd.randint(0, 9)) if rnd.random() < 0.33 else rnd.gauss(5, 3)) for _ in range(3000)]
    data += [(f"g{i % 40}", rnd.expovariate(1)) for i in range(6000)]
    data += [("nulls", None)] * 5 + [("one", 4.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for q in (0.0, 0.03, 0.5, 0.97, 1.0):
        got = dict(rows(quantiles.exact_quantile(df, ["v"], q, ["g"], accuracy).select("g", "v")))
        got.pop("nulls", None)
        assert got == {g: disc(vs, q) for g, vs in groups.items()}
    pct = quantiles.linear_percentiles(df, "v", [10, 25, 50, 75, 90], ["g"], accuracy)
    for r in pct.collect():
        for p in (10, 25, 50, 75, 90):
            assert r[f"p{p}"] == pytest.approx(linear(groups[r["g"]], p / 100), abs=1e-12)


def test_percentiles_interpolate(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "v double")
    assert rows(quantiles.linear_percentiles(df, "v", [10, 25, 50])) == [(1.3, 1.75, 2.5)]


def test_clip(spark):
    data = [(D(2023, 1, 1), 1), (D(2023, 1, 1), 5), (D(2023, 1, 1), 9), (D(2023, 1, 1), None), (D(2023, 2, 1), None)]
    df = spark.createDataFrame(data, "snapshot_date date, v int")
    caps = clipping.fit_caps(df, ["v"], q=0.5, exact=True)
    once = clipping.clip_above(df, caps, ["v"])
    assert dict(once.dtypes)["v"] == "double"
    assert rows(once) == sorted(
        [(D(2023, 1, 1), 1.0), (D(2023, 1, 1), 5.0), (D(2023, 1, 1), 5.0), (D(2023, 1, 1), None), (D(2023, 2, 1), None)],
        key=repr,
    )
    assert rows(clipping.clip_above(once, caps, ["v"])) == rows(once)


def test_approximate_caps_stay_within_the_rank_error(spark):
    df = spark.range(20_000).select(F.lit(D(2023, 1, 1)).alias("snapshot_date"), F.col("id").cast("double").alias("v"))
    cap = clipping.fit_caps(df.repartition(6), ["v"]).first()["v"]
    assert abs(cap / 20_000 - 0.97) <= 0.011


def test_approximate_caps_equal_approx_quantile(spark):
    rnd = random.Random(2)
    data = [(D(2023, 1 + i % 2, 1), rnd.expovariate(1)) for i in range(400)] + [(D(2023, 1, 1), None)]
    df = spark.createDataFrame(data, "snapshot_date date, v double").coalesce(1)
    caps = {r["snapshot_date"]: r["v"] for r in clipping.fit_caps(df, ["v"]).collect()}
    for month, cap in caps.items():
        assert [cap] == df.filter(F.col("snapshot_date") == month).approxQuantile("v", [0.97], 0.01)


def test_a_rank_outside_its_bracket_is_an_error(spark, monkeypatch):
    from featuremart.operators import quantiles

    real = quantiles.sketch
    shifted = lambda v, probs, accuracy: real(v, [min(1.0, p + 0.05) for p in probs], accuracy)
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    good = quantiles.linear_percentiles(df, "v", [50]).first()[0]
    monkeypatch.setattr(quantiles, "sketch", shifted)
    with pytest.raises(Exception, match="outside its bracket"):
        quantiles.linear_percentiles(df, "v", [50]).collect()
    assert good == 49999.5


# ---- imputation, encoding, scaling


def test_impute_integer_takes_the_whole_part_of_the_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (None, 2.0), (5, None)], "i int, d double")
    out = imputation.impute_means(df, imputation.fit_means(df))
    assert out.dtypes == [("i", "int"), ("d", "double")]
    assert [tuple(r) for r in out.collect()] == [(1, 1.0), (2, 1.5), (2, 2.0), (5, 1.5)]
    kept = imputation.impute_means(df, imputation.fit_means(df), keep_type=False, indicators=True)
    assert [r["i_missing"] for r in kept.collect()] == [0, 0, 1, 0]
    assert kept.collect()[2]["i"] == pytest.approx(8 / 3)


def test_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("A b",)], "c string")
    vocabulary = encoding.fit_categories(df, ["c"])
    assert vocabulary == {"c": ["A b", "a", "b"]}
    out = encoding.one_hot(df, vocabulary)
    assert out.columns == ["c_a b", "c_a", "c_b"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 1), (0, 1, 0), (0, 0, 0), (1, 0, 0)]


def test_one_hot_unseen_values_and_collisions(spark):
    df = spark.createDataFrame([("x",)], "c string")
    assert rows(encoding.one_hot(df, {"c": ["y"]})) == [(0,)]
    with pytest.raises(ValueError, match="collide"):
        encoding.one_hot(df, {"c": ["X", "x"]})


def test_category_order_and_limit(spark):
    df = spark.createDataFrame([("z",), ("z",), ("m",), ("a",)], "c string")
    assert encoding.fit_categories(df, ["c"])["c"] == ["z", "a", "m"]
    assert [r["category"] for r in encoding.category_index(df, ["c"]).orderBy("index").collect()] == ["z", "a", "m"]
    few = encoding.fit_categories(df, ["c"], widest=2)
    assert few["c"] == ["z", "a", None]
    out = encoding.one_hot(df.union(spark.createDataFrame([(None,)], "c string")), few)
    assert out.columns == ["c_z", "c_a", "c__other"]
    assert rows(out) == sorted([(1, 0, 0), (1, 0, 0), (0, 0, 1), (0, 1, 0), (0, 0, 0)], key=repr)


def test_no_limit_on_categories_or_classes(spark):
    """1,500 categories: the wide form counts those without a column; 150 classes keep exact parts."""
    df = spark.range(4000).select("id", F.concat(F.lit("c"), (F.col("id") % 1500).cast("string")).alias("c"))
    fitted = encoding.fit_categories(df, ["c"])
    assert len(fitted["c"]) == 1001 and fitted["c"][-1] is None
    named = df.filter(F.col("c").isin([v for v in fitted["c"] if v])).count()
    assert encoding.one_hot(df, fitted).agg(F.sum("c__other")).first()[0] == 4000 - named
    split = splits.stratified_split(df.select("id", (F.col("id") % 150).alias("label")), "id")
    assert {r["split"]: r["rows"] for r in splits.split_report(split).collect()} == {"test": 800, "val": 800, "train": 2400}


def test_split_without_labels(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, label int")
    assert rows(splits.stratified_split(df, "id")) == sorted([(1, None, None), (2, None, None)], key=repr)
    assert splits.stratified_split(df.limit(0), "id").count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Auto Loan and Credit-Builder Loan"), (2, None), (3, "Auto Loan, Auto Loan")], "id int, t string")
    words = tokens.fit_tokens(df, "t")
    assert words == ["auto_loan", "credit-builder_loan"]
    assert rows(tokens.pivot_tokens(df, "t", words).drop("t")) == [(1, 1, 1), (2, 0, 0), (3, 2, 0)]
    assert rows(tokens.long_token_counts(df, "t", ["id"])) == [(1, "auto_loan", 1), (1, "credit-builder_loan", 1), (3, "auto_loan", 2)]
    few = tokens.fit_tokens(df, "t", widest=1)
    assert few == ["auto_loan", None]
    out = tokens.pivot_tokens(df, "t", few).drop("t")
    assert out.columns == ["id", "auto_loan", "t__other"]
    assert rows(out) == [(1, 1, 1), (2, 0, 0), (3, 2, 0)]


def test_scale_uses_population_deviation_and_keeps_constants_at_zero(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (6.0, 7.0), (None, 7.0)], "x double, c double")
    out = scaling.scale(df, scaling.fit_scaler(df, ["x", "c"])).collect()
    dev = statistics.pstdev([1, 2, 6])
    assert [r["x"] for r in out[:3]] == pytest.approx([-2 / dev, -1 / dev, 3 / dev])
    assert out[3]["x"] is None and {r["c"] for r in out} == {0.0}


# ---- point in time


def brute_point_in_time(facts, anchors):
    out = {}
    for key in {k for k, _ in anchors}:
        pairs = [v for k, d, v in facts if k == key for ak, ad in anchors if ak == key and d <= ad]
        if pairs:
            vals = [v for v in pairs if v is not None]
            out[key] = sum(vals) / len(vals) if vals else None
    return out


def test_point_in_time_window_is_inclusive(spark):
    facts = spark.createDataFrame([("a", D(2023, 1, 1), 2), ("a", D(2023, 1, 2), 9), ("b", D(2023, 1, 1), 1)], "k string, d date, v int")
    anchors = spark.createDataFrame([("a", D(2023, 1, 1))], "k string, d date")
    assert rows(point_in_time_means(facts, anchors, "k", "d", "d", ["v"])) == [("a", 2.0)]


@pytest.mark.parametrize("mode", ["all", "min"])
def test_point_in_time_equals_a_plain_join(spark, mode):
    """Repeated anchors count repeatedly; a third of the facts belong to one key."""
    rnd = random.Random(5)
    day = lambda: D(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 20))
    facts = [("hot" if rnd.random() < 0.34 else f"k{rnd.randint(0, 30)}", day(), rnd.choice([None, 1, 5, 8])) for _ in range(900)]
    anchors = [("hot" if rnd.random() < 0.34 else f"k{rnd.randint(0, 40)}", day()) for _ in range(120)]
    got = point_in_time_means(
        spark.createDataFrame(facts, "k string, d date, v int"),
        spark.createDataFrame(anchors, "k string, a date"),
        "k", "d", "a", ["v"], anchor=mode,
    )
    used = anchors if mode == "all" else list({k: min(d for kk, d in anchors if kk == k) for k, _ in anchors}.items())
    want = brute_point_in_time(facts, used)
    got = dict(rows(got))
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v))


# ---- pairing


def test_pairing_goes_by_key(spark):
    features = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, x int")
    labels = spark.createDataFrame([("c", 0), ("a", 1), ("z", 1)], "id string, label int")
    assert rows(pairing.pair_by_key(features, labels, "id")) == [("a", 1, 1), ("c", 3, 0)]
    gate = pairing.pairing_gate(features, labels, "id").first().asDict()
    assert gate == {
        "feature_rows": 3,
        "label_rows": 3,
        "features_without_label": 1,
        "labels_without_features": 1,
        "counts_match": True,
    }


# ---- splits


def test_time_windows():
    w = splits.TimeWindows.before(D(2025, 1, 1))
    assert (w.train_start, w.train_end, w.oot_start, w.oot_end) == (
        D(2023, 10, 1), D(2024, 9, 30), D(2024, 10, 1), D(2024, 12, 31),
    )
    assert splits.TimeWindows.before(D(2024, 5, 31), 1, 3).oot_start == D(2024, 2, 29)


def test_window_names(spark):
    days = ["2023-09-30", "2023-10-01", "2024-09-30", "2024-10-01", "2024-12-31", "2025-01-01"]
    df = spark.createDataFrame([(D.fromisoformat(d),) for d in days], "d date")
    out = splits.time_split(df, "d", splits.TimeWindows.before(D(2025, 1, 1)))
    assert [r["split"] for r in out.collect()] == ["none", "train", "train", "oot", "oot", "none"]


@pytest.mark.parametrize("counts", [{0: 58, 1: 341}, {0: 5, 1: 5}, {0: 1, 1: 2}, {"a": 7, "b": 33, "c": 960}, {0: 3}])
def test_sizes(spark, counts):
    classes = spark.createDataFrame([(str(k), n) for k, n in counts.items()], "_label string, _n long")
    counts = {str(k): n for k, n in counts.items()}
    sizes = {r["_label"]: (r["n_test"], r["n_val"]) for r in splits.stratified_sizes(classes).collect()}
    assert sizes.keys() == counts.keys()
    total = sum(counts.values())
    n_test = sum(t for t, _ in sizes.values())
    n_val = sum(v for _, v in sizes.values())
    assert n_test == math.ceil(0.2 * total)
    assert n_val == math.ceil(0.25 * (total - n_test))
    for k, (t, v) in sizes.items():
        assert 0 <= t and 0 <= v and t + v <= counts[k]
        assert abs(t - 0.2 * counts[k]) <= 1


def test_stratified_split(spark):
    data = [(i, 1 if i < 341 else 0) for i in range(399)]
    df = spark.createDataFrame(data, "id long, label int").repartition(5)
    out = splits.stratified_split(df, "id")
    counts = {(r["split"], r["label"]): r["rows"] for r in splits.class_distribution(out).collect()}
    assert counts == {("test", 0): 12, ("test", 1): 68, ("val", 0): 12, ("val", 1): 68, ("train", 0): 34, ("train", 1): 205}
    again = splits.stratified_split(df.repartition(3), "id")
    assert rows(out) == rows(again)
    assert rows(out) != rows(splits.stratified_split(df, "id", seed=7))
    report = {r["split"]: (r["rows"], round(r["percent"], 2)) for r in splits.split_report(out).collect()}
    assert report == {"test": (80, 20.05), "val": (80, 20.05), "train": (239, 59.9)}


def test_split_hash_order_is_the_global_order(spark):
    """The searched cuts give the rows a sort of the whole class would give."""
    import hashlib

    df = spark.range(5000).select(F.col("id"), (F.col("id") < 1700).cast("int").alias("label"))
    out = splits.stratified_split(df, "id")
    split = {r["id"]: r["split"] for r in out.collect()}
    for label, ids in ((1, range(1700)), (0, range(1700, 5000))):
        ordered = sorted(ids, key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
        names = [split[i] for i in ordered]
        assert names == sorted(names, key=["test", "val", "train"].index)


# ---- brackets and buckets of any size


@pytest.mark.parametrize("most", [300, 20, 3])
def test_refined_brackets_give_the_same_values(spark, monkeypatch, most):
    monkeypatch.setattr(quantiles, "PARTS", 4)
    rnd = random.Random(most)
    data = [(k, float(rnd.choice([rnd.random(), rnd.randint(0, 5)]))) for k in "abc" for _ in range({"a": 900, "b": 40, "c": 1}[k])]
    df = spark.createDataFrame(data + [("a", None), ("d", None)], "k string, v double")
    probs = [0.1, 0.5, 0.97]
    place = lambda n, p: {"lower": F.floor(p * (n - 1)), "upper": F.ceil(p * (n - 1))}
    got = quantiles.order_statistics(df, "v", probs, place, ["k"], accuracy=20, most=most)
    want = set()
    for k in "abc":
        vals = sorted(v for g, v in data if g == k)
        for i, p in enumerate(probs):
            want.add((k, i, len(vals), vals[math.floor(p * (len(vals) - 1))], vals[math.ceil(p * (len(vals) - 1))]))
    assert {tuple(r) for r in got.select("k", "_i", "_n", "lower", "upper").collect()} == want
    alone = quantiles.order_statistics(df, "v", [0.5], place, accuracy=20, most=most).first()
    vals = sorted(v for _, v in data)
    assert (alone["lower"], alone["upper"]) == (vals[(len(vals) - 1) // 2], vals[math.ceil((len(vals) - 1) / 2)])


def test_no_window_over_more_than_the_bound(spark, monkeypatch):
    """Ten million distinct values with a coarse sketch: what reaches the window stays below the bound."""
    seen, real = [], quantiles._refined

    def watched(counts, *rest):
        out = real(counts, *rest)
        seen.append((counts.filter("_v is not null").count(), out.filter("_v is not null").count()))
        return out

    monkeypatch.setattr(quantiles, "_refined", watched)
    n = 10_000_000
    df = spark.range(n).select(F.expr("id * 7919 % 10000000").cast("double").alias("v"))
    got = quantiles.order_statistics(df, "v", [0.25], lambda n, p: {"x": F.floor(p * n)}, accuracy=100, most=50_000).first()
    assert got["x"] == n // 4
    ((before, after),) = seen
    assert before > 400_000 and 0 < after <= 50_000


def test_every_group_has_buckets_of_its_own(spark):
    """One group lies in a narrow band of the others' range; its buckets are as small as theirs."""
    from featuremart.operators.metrics import bucketed_scores

    rnd = random.Random(5)
    data = [("wide", rnd.random() * 1e6) for _ in range(4000)] + [("narrow", 10 + rnd.random() / 1e3) for _ in range(4000)] + [(None, 1.0), ("one", 2.0)]
    counts = spark.createDataFrame(data, "k string, _s double")
    placed = bucketed_scores(counts, ["k"], buckets=128)
    assert sorted(placed.columns) == ["_bucket", "_s", "k"] and placed.count() == len(data)
    sizes = {(r["k"], r["_bucket"]): r["count"] for r in placed.groupBy("k", "_bucket").count().collect()}
    for k in ("wide", "narrow"):
        own = [n for (g, _), n in sizes.items() if g == k]
        assert len(own) > 100 and max(own) <= 2 * 4000 / 128
    last = {}
    for r in placed.orderBy("k", "_s").collect():
        assert r["_bucket"] >= last.get(r["k"], 0)
        last[r["k"]] = r["_bucket"]
    alone = bucketed_scores(counts.select("_s"), buckets=16)
    assert alone.count() == len(data) and alone.select("_bucket").distinct().count() > 8


def test_first_trees_score_like_a_shorter_fit(spark):
    rows = spark.range(300).selectExpr(
        "cast(hash(id) % 7 + id % 5 > 2 as int) AS label", "double(hash(id) % 7) AS a", "double(id % 5) AS b", "id",
        "IF(id % 3 = 0, 'val', 'train') AS split",
    )
    rows = boosting.assemble(rows, ["a", "b"]).select("id", "label", "split", "features")
    params = {"max_depth": 2, "subsample": 0.8, "learning_rate": 0.3}
    longest = boosting.train(rows, {**params, "n_estimators": 4})
    got = {(r["n_estimators"], r["id"]): r[boosting.SCORE] for r in boosting.prefix_scores(longest, rows, [1, 2, 4]).collect()}
    for n in (1, 2, 4):
        own = boosting.add_scores(boosting.train(rows, {**params, "n_estimators": n}), rows).collect()
        assert all(abs(got[n, r["id"]] - r[boosting.SCORE]) < 1e-12 for r in own)
    assert len(got) == 900

    grid = {"max_depth": [1, 2], "n_estimators": [4, 1, 2]}
    found = boosting.search(rows, grid)
    table = found.candidates.collect()
    assert [r["candidate"] for r in table] == list(range(6))
    best = max(table, key=lambda r: (r["val_f1"], -r["candidate"]))
    assert {k: str(v) for k, v in found.best_params.items()} == best["params"]
    assert len(found.best_model.trees) == found.best_params["n_estimators"]
