"""Joins, aggregates, imputation, encoding, splits, scaling, and the feature store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from featuremart.operators import splits
from featuremart.operators.encoding import category_index, fit_categories, one_hot
from featuremart.operators.imputation import fit_means, impute_means
from featuremart.operators.pairing import pair_by_key, pairing_gate, semi_join
from featuremart.operators.pointintime import point_in_time_means
from featuremart.operators.profiling import table_shape
from featuremart.operators.scaling import fit_scaler, scale
from featuremart.plans import gold, silver
from featuremart.plans.training import label_merges, labelled_rows
from featuremart.sources.scratch import scratch_dir

from .registry import Tables, query
from .standins import (
    ATTR_SQL,
    CLICK_SQL,
    FIN_CLIPPED,
    FIN_KINDS,
    FIN_SQL,
    LMS_SQL,
    LOAN_TOKENS,
    SCORES_SQL,
    clicks,
    loan_starts,
    raw_attributes,
    raw_financials,
    raw_lms,
    scores,
)


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


@query(
    "multi_key_inner_join",
    """
WITH o AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
                  count(*) AS orders_placed, max(o_totalprice) AS largest FROM orders GROUP BY ALL),
     l AS (SELECT o_custkey AS customer, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
                  count(*) AS lines_shipped, max(l_extendedprice) AS dearest
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o.customer, o.snapshot_date, orders_placed, largest, lines_shipped, dearest
FROM o JOIN l ON o.customer = l.customer AND o.snapshot_date = l.snapshot_date""",
)
def multi_key_inner_join(t: Tables):
    keys = ["customer", "snapshot_date"]
    placed = t.orders.groupBy(
        F.col("o_custkey").alias("customer"), F.trunc("o_orderdate", "MM").alias("snapshot_date")
    ).agg(F.count(F.lit(1)).alias("orders_placed"), F.max("o_totalprice").alias("largest"))
    shipped = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("customer"), F.trunc("l_shipdate", "MM").alias("snapshot_date"))
        .agg(F.count(F.lit(1)).alias("lines_shipped"), F.max("l_extendedprice").alias("dearest"))
    )
    return placed.join(shipped, on=keys, how="inner")


@query(
    "label_semi_join",
    f"WITH {LMS_SQL} SELECT * FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT customer_id FROM labels_built WHERE label = 1)",
)
def label_semi_join(t: Tables):
    """Customers with a loan that went bad."""
    bad = gold.build_labels(silver.clean_lms(raw_lms(t))).filter(F.col("label") == 1)
    customers = t.customer.withColumn("customer_id", F.col("c_custkey").cast("string"))
    return semi_join(customers, bad, ["customer_id"]).drop("customer_id")


@query("point_in_time_features", f"WITH {CLICK_SQL} SELECT * FROM click_means")
def point_in_time_features(t: Tables):
    means = point_in_time_means(
        clicks(t), loan_starts(t), "customer_id", "snapshot_date", "snapshot_date", ["cents", "k"]
    )
    return rounded(means, ["avg_cents", "avg_k"])


@query(
    "point_in_time_first_anchor",
    f"""
WITH {CLICK_SQL},
firsts AS (SELECT customer_id, min(mob_date) AS mob_date FROM anchors GROUP BY 1)
SELECT c.customer_id, round(avg(cents), 6) AS avg_cents, round(avg(k), 6) AS avg_k
FROM clicks c JOIN firsts f ON c.customer_id = f.customer_id AND c.snapshot_date <= f.mob_date GROUP BY 1""",
)
def point_in_time_first_anchor(t: Tables):
    means = point_in_time_means(
        clicks(t), loan_starts(t), "customer_id", "snapshot_date", "snapshot_date", ["cents", "k"], anchor="min"
    )
    return rounded(means, ["avg_cents", "avg_k"])


@query(
    "left_enrich",
    f"""
WITH {CLICK_SQL}
SELECT c.c_custkey, c.c_name, m.avg_cents, m.avg_k
FROM customer c LEFT JOIN click_means m ON CAST(c.c_custkey AS VARCHAR) = m.customer_id""",
)
def left_enrich(t: Tables):
    customers = t.customer.select(F.col("c_custkey").cast("string").alias("customer_id"), "c_custkey", "c_name")
    return customers.join(point_in_time_features(t), on="customer_id", how="left").drop("customer_id")


@query(
    "pair_features_labels",
    "SELECT d.doc_id, d.lang, d.n_chars, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id ORDER BY 1",
)
def pair_features_labels(t: Tables):
    features = t.documents.select("doc_id", "lang", "n_chars")
    labels = t.labels.select("doc_id", F.col("quality").alias("label"))
    return pair_by_key(features, labels, "doc_id").orderBy("doc_id")


PAIR_WINDOWS = splits.TimeWindows.before(date(1998, 1, 1))


@query(
    "labelled_rows",
    f"""
WITH {LMS_SQL},
placed AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
                  count(*) AS orders_placed FROM orders GROUP BY 1, 2),
resolved AS (
  SELECT loan_id, customer_id, label, snapshot_date FROM labels_built
  QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY snapshot_date, label DESC, customer_id) = 1),
latest AS (
  SELECT l.loan_id, l.customer_id, l.label, l.snapshot_date AS label_date, max(p.snapshot_date) AS snapshot_date
  FROM resolved l JOIN placed p
    ON p.customer_id = l.customer_id AND p.snapshot_date <= CAST(l.snapshot_date - INTERVAL 6 MONTH AS DATE)
  GROUP BY 1, 2, 3, 4)
SELECT customer_id, snapshot_date, orders_placed, loan_id, label, label_date,
       CASE WHEN label_date BETWEEN DATE '{PAIR_WINDOWS.train_start}' AND DATE '{PAIR_WINDOWS.train_end}' THEN 'train'
            WHEN label_date BETWEEN DATE '{PAIR_WINDOWS.oot_start}' AND DATE '{PAIR_WINDOWS.oot_end}' THEN 'oot'
            ELSE 'none' END AS "window"
FROM latest JOIN placed USING (customer_id, snapshot_date)""",
)
def labelled(t: Tables):
    """Months with orders play the features: customers have many of them, and many loans."""
    placed = t.orders.groupBy(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.trunc("o_orderdate", "MM").alias("snapshot_date"),
    ).agg(F.count(F.lit(1)).alias("orders_placed"))
    return labelled_rows(placed, gold.build_labels(silver.clean_lms(raw_lms(t))), PAIR_WINDOWS)


@query(
    "label_merges",
    f"""
WITH {LMS_SQL},
per_loan AS (SELECT loan_id, count(*) AS n, count(DISTINCT (snapshot_date, label)) AS kinds FROM labels_built GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS label_rows, count(*) AS loans, CAST(sum(n - 1) AS BIGINT) AS merged_rows,
       count(*) FILTER (WHERE kinds > 1) AS differing_loans, CAST(0 AS BIGINT) AS rows_without_loan FROM per_loan""",
)
def merges(t: Tables):
    return label_merges(gold.build_labels(silver.clean_lms(raw_lms(t))))


@query(
    "pairing_gate",
    """
SELECT (SELECT count(*) FROM documents) AS feature_rows, (SELECT count(*) FROM labels) AS label_rows,
       (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS features_without_label,
       (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS labels_without_features,
       (SELECT count(*) FROM documents) = (SELECT count(*) FROM labels) AS counts_match""",
)
def gate(t: Tables):
    return pairing_gate(t.documents, t.labels, "doc_id")


@query(
    "mean_impute",
    """
WITH holes AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         nullif(c_nationkey, 0) AS nation, c_mktsegment FROM customer)
SELECT c_custkey, round(coalesce(balance, (SELECT avg(balance) FROM holes)), 6) AS balance,
       coalesce(nation, CAST(trunc((SELECT avg(nation) FROM holes)) AS INTEGER)) AS nation, c_mktsegment,
       CAST(balance IS NULL AS INTEGER) AS balance_missing, CAST(nation IS NULL AS INTEGER) AS nation_missing
FROM holes""",
)
def mean_impute(t: Tables):
    holes = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_nationkey", F.lit(0)).alias("nation"),
        "c_mktsegment",
    )
    return rounded(impute_means(holes, fit_means(holes, ["balance", "nation"]), indicators=True), ["balance"])


SEGMENTS = ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "one_hot",
    "SELECT c_custkey, "
    + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS segment_{s.lower()}" for s in SEGMENTS)
    + " FROM customer",
)
def one_hot_segments(t: Tables):
    """The fifth segment is turned into null: zeros everywhere."""
    rows = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return one_hot(rows, fit_categories(rows, ["segment"]))


@query(
    "category_index",
    """
WITH melted AS (
  SELECT 'p_type' AS "column", p_type AS category FROM part
  UNION ALL SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part),
counted AS (SELECT "column", category, count(*) AS n FROM melted GROUP BY ALL)
SELECT "column", category, n,
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, category) - 1 AS INTEGER) AS "index"
FROM counted""",
)
def category_indexes(t: Tables):
    return category_index(t.part, ["p_type", "p_brand", "p_size"])


TRAIN_DATE = date(2001, 1, 1)


@query(
    "time_split",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
       CASE WHEN o_orderdate >= DATE '1999-10-01' AND o_orderdate < DATE '2000-10-01' THEN 'train'
            WHEN o_orderdate >= DATE '2000-10-01' AND o_orderdate < DATE '2001-01-01' THEN 'oot'
            ELSE 'none' END AS split
FROM orders""",
)
def time_split(t: Tables):
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return splits.time_split(days, "day", splits.TimeWindows.before(TRAIN_DATE))


STRATIFIED_SQL = f"""
{SCORES_SQL},
hashed AS (SELECT doc_id, actual_label AS label,
                  row_number() OVER (PARTITION BY actual_label ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) AS r
           FROM scores),
per_class AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM hashed GROUP BY 1),
rest0 AS (SELECT *, total - ceil(0.2::DOUBLE * total) AS draws,
                 (total - ceil(0.2::DOUBLE * total)) * n / total AS share FROM per_class),
rest1 AS (SELECT label, n, floor(share) AS low, draws - sum(floor(share)) OVER () AS extra,
                 row_number() OVER (ORDER BY share - floor(share) DESC, label) AS place FROM rest0),
rest AS (SELECT label, n, low + CASE WHEN place <= extra THEN 1 ELSE 0 END AS kept FROM rest1),
train0 AS (SELECT *, sum(kept) OVER () AS total FROM rest),
train1 AS (SELECT label, n, kept, total - ceil(0.2::DOUBLE / (1 - 0.2::DOUBLE) * total) AS draws,
                  (total - ceil(0.2::DOUBLE / (1 - 0.2::DOUBLE) * total)) * kept / total AS share FROM train0),
train2 AS (SELECT *, draws - sum(floor(share)) OVER () AS extra,
                  row_number() OVER (ORDER BY share - floor(share) DESC, label) AS place FROM train1),
sizes AS (SELECT label, n - kept AS n_test,
                 kept - floor(share) - CASE WHEN place <= extra THEN 1 ELSE 0 END AS n_val FROM train2),
split_rows AS (
  SELECT h.doc_id, h.label, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split
  FROM hashed h JOIN sizes s ON h.label = s.label)"""


def split_scores(t: Tables):
    rows = scores(t).select("doc_id", F.col("actual_label").alias("label"))
    return splits.stratified_split(rows, "doc_id")


@query("stratified_split", f"WITH {STRATIFIED_SQL} SELECT * FROM split_rows")
def stratified_split(t: Tables):
    return split_scores(t)


@query(
    "class_distribution",
    f"WITH {STRATIFIED_SQL} SELECT split, label, count(*) AS rows FROM split_rows GROUP BY ALL",
)
def class_distribution(t: Tables):
    return splits.class_distribution(split_scores(t))


@query(
    "split_report",
    f"""
WITH {STRATIFIED_SQL}
SELECT split, count(*) AS rows, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM split_rows), 6) AS percent
FROM split_rows GROUP BY 1""",
)
def split_report(t: Tables):
    return rounded(splits.split_report(split_scores(t)), ["percent"])


SCALED = ("l_quantity", "l_extendedprice", "l_discount", "constant")


@query(
    "standard_scale",
    """
WITH r AS (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_shipdate < TIMESTAMP '1999-01-01' AS is_train FROM lineitem),
s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2,
             stddev_pop(l_extendedprice) AS s2, avg(l_discount) AS m3, stddev_pop(l_discount) AS s3
      FROM r WHERE is_train)
SELECT l_orderkey, round((l_quantity - m1) / s1, 6) AS l_quantity, round((l_extendedprice - m2) / s2, 6) AS l_extendedprice,
       round((l_discount - m3) / s3, 6) AS l_discount, 0.0::DOUBLE AS constant, is_train
FROM r, s""",
)
def standard_scale(t: Tables):
    """Fitted on the lines shipped before 1999, applied to all; a constant column scales to 0."""
    rows = t.lineitem.select(
        "l_orderkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        F.lit(7.0).alias("constant"),
        (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")).alias("is_train"),
    )
    scaler = fit_scaler(rows.filter("is_train"), SCALED)
    return rounded(scale(rows, scaler), SCALED)


STORE_CATEGORIES = {
    "occupation": SEGMENTS,
    "payment_of_min_amount": ("NM", "No", "Yes"),
    "credit_mix": ("Bad", "Good"),
    "payment_behaviour_spent": ("High", "Low"),
    "payment_behaviour_value": ("Medium", "Small"),
}
STORE_FLAGS = ", ".join(
    f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS {c}_{v.lower()}" for c, vs in STORE_CATEGORIES.items() for v in vs
)
STORE_TOKENS = ", ".join(
    f"CAST((token_a = '{w}')::INTEGER + (token_b = '{w}')::INTEGER + (token_c = '{w}')::INTEGER AS INTEGER) AS \"{w}\""
    for w in LOAN_TOKENS
)
STORE_SQL = f"""
{ATTR_SQL}, {FIN_SQL}, {LMS_SQL}, {CLICK_SQL.replace("round(avg(cents), 6)", "avg(cents)").replace("round(avg(k), 6)", "avg(k)")},
joined AS (
  SELECT f.*, a.age, a.occupation, l.token_a, l.token_b, l.token_c, m.avg_cents, m.avg_k,
         f.credit_history_age_year * 12 + f.credit_history_age_month AS history_months
  FROM fin f JOIN attr a ON f.customer_id = a.customer_id
  JOIN loan_list l ON f.customer_id = l.customer_id AND f.snapshot_date = l.snapshot_date
  LEFT JOIN click_means m ON f.customer_id = m.customer_id
  WHERE f.customer_id IN (SELECT customer_id FROM labels_built)),
means AS (
  SELECT CAST(trunc(avg(age)) AS INTEGER) AS age, avg(delay_from_due_date) AS delay, avg(avg_cents) AS avg_cents, avg(avg_k) AS avg_k
  FROM joined),
store AS (
  SELECT j.customer_id, j.snapshot_date, coalesce(j.age, m.age) AS age, annual_income, num_of_loan,
         round(coalesce(delay_from_due_date, m.delay), 6) AS delay_from_due_date,
         history_months AS credit_history_age_month, {STORE_TOKENS},
         round(coalesce(j.avg_cents, m.avg_cents), 6) AS avg_cents, round(coalesce(j.avg_k, m.avg_k), 6) AS avg_k, {STORE_FLAGS}
  FROM joined j, means m)"""


def build_store(t: Tables, keep: bool = True):
    """Feature store over the stand-ins, one row per customer and month with an order."""
    fin = silver.clean_financials(
        raw_financials(t), kinds=FIN_KINDS, clipped=FIN_CLIPPED, loan_types=LOAN_TOKENS, exact_caps=True
    )
    months = t.orders.select(
        F.col("o_custkey").cast("string").alias("customer_id"), F.trunc("o_orderdate", "MM").alias("snapshot_date")
    ).distinct()
    attributes = months.join(silver.clean_attributes(raw_attributes(t).withColumn("snapshot_date", F.lit(None))).drop("snapshot_date"), "customer_id")
    labels = gold.build_labels(silver.clean_lms(raw_lms(t)))
    store = gold.build_features(
        attributes,
        fin.main,
        fin.loan_type,
        clicks(t).drop("event_type"),
        loan_starts(t),
        labels,
        click_columns=("cents", "k"),
        keep=keep,
    )
    return rounded(store, ["delay_from_due_date", "avg_cents", "avg_k"])


@query("feature_store", f"WITH {STORE_SQL} SELECT * FROM store")
def feature_store(t: Tables):
    return build_store(t)


@query(
    "store_shape",
    f"""
WITH {LMS_SQL}
SELECT 'label_store' AS store, (SELECT count(*) FROM labels_built) AS row_count, 5 AS column_count
UNION ALL SELECT 'documents', (SELECT count(*) FROM documents), 5""",
)
def store_shape(t: Tables):
    labels = gold.build_labels(silver.clean_lms(raw_lms(t)))
    return (
        table_shape(labels)
        .select(F.lit("label_store").alias("store"), "row_count", "column_count")
        .unionByName(table_shape(t.documents).select(F.lit("documents").alias("store"), "row_count", "column_count"))
    )


@query(
    "gold_roundtrip",
    f"""
WITH {STORE_SQL},
features AS (
  SELECT snapshot_date, count(*) AS feature_rows, CAST(sum(num_of_loan) AS BIGINT) AS loans,
         CAST(sum("1-urgent") AS BIGINT) AS urgent FROM store GROUP BY 1),
marks AS (SELECT snapshot_date, count(*) AS label_rows, CAST(sum(label) AS BIGINT) AS bad FROM labels_built GROUP BY 1)
SELECT f.snapshot_date, feature_rows, loans, urgent, coalesce(label_rows, 0) AS label_rows, coalesce(bad, 0) AS bad
FROM features f LEFT JOIN marks m ON f.snapshot_date = m.snapshot_date
WHERE f.snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-01'""",
)
def gold_roundtrip(t: Tables):
    """Silver tables on disk, both stores written for the dates of three years, read back."""
    root = scratch_dir(t.spark, "mart")
    fin = silver.clean_financials(
        raw_financials(t), kinds=FIN_KINDS, clipped=FIN_CLIPPED, loan_types=LOAN_TOKENS, exact_caps=True
    )
    months = t.orders.select(
        F.col("o_custkey").cast("string").alias("customer_id"), F.trunc("o_orderdate", "MM").alias("snapshot_date")
    ).distinct()
    people = silver.clean_attributes(raw_attributes(t).withColumn("snapshot_date", F.lit(None))).drop("snapshot_date")
    made = {
        "attributes": months.join(people, "customer_id"),
        "financials": fin.main,
        "loan_type": fin.loan_type,
        "clickstream": clicks(t).select("customer_id", "snapshot_date", *[(F.col("cents") * i).alias(f"fe_{i}") for i in range(1, 21)]),
        "lms": silver.clean_lms(raw_lms(t)),
    }
    for name, df in made.items():
        df.write.parquet(f"{root}/silver/{name}")
    dates = [f"{y}-{m:02d}-01" for y in (1996, 1997, 1998) for m in range(1, 13)]
    features, labels = gold.write_gold(t.spark, f"{root}/silver", f"{root}/gold", dates)
    found = features.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("feature_rows"), F.sum("num_of_loan").cast("long").alias("loans"), F.sum("1-urgent").alias("urgent")
    )
    marks = labels.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("label_rows"), F.sum("label").alias("bad"))
    return found.join(marks, "snapshot_date", "left").fillna(0, ["label_rows", "bad"])
