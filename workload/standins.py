"""The credit tables, played by the test tables.

Customers play the attributes, orders the financials, line items the loan ledger, events the clicks,
labelled documents the scored rows. Values are turned into dirty raw text the way the sources have
it, so that the cleaners have work to do. Each stand-in comes with the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.scores import predicted_class
from featuremart.sources.scratch import cut

from .registry import Tables

# ---- attributes: raw text per customer

ATTR_SQL = r"""
attr_raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         c_name AS name,
         concat(CAST(CAST(floor(c_acctbal / 50) AS BIGINT) AS VARCHAR), '_') AS age,
         concat(CAST(c_custkey + 100 AS VARCHAR), '-', lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), '-',
                lpad(CAST(c_nationkey * 397 AS VARCHAR), 4, '0')) AS ssn,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '_______' ELSE c_mktsegment END AS occupation
  FROM customer),
attr AS (
  SELECT customer_id, name,
         CASE WHEN TRY_CAST(regexp_extract(age, '([-+]?\d*\.?\d+)', 1) AS INTEGER) BETWEEN 0 AND 120
              THEN TRY_CAST(regexp_extract(age, '([-+]?\d*\.?\d+)', 1) AS INTEGER) END AS age,
         CASE WHEN regexp_full_match(ssn, '\d{3}-\d{2}-\d{4}') THEN ssn END AS ssn,
         nullif(occupation, '_______') AS occupation
  FROM attr_raw)"""


def raw_attributes(t: Tables) -> DataFrame:
    text = lambda c: c.cast("string")
    nation = F.col("c_nationkey")
    return t.customer.select(
        text(F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(text(F.floor(F.col("c_acctbal") / 50)), F.lit("_")).alias("age"),
        F.concat_ws(
            "-", text(F.col("c_custkey") + 100), F.lpad(text(nation), 2, "0"), F.lpad(text(nation * 397), 4, "0")
        ).alias("ssn"),
        F.when(F.col("c_mktsegment") == "BUILDING", "_______").otherwise(F.col("c_mktsegment")).alias("occupation"),
    )


# ---- financials: raw text per customer and month

FIN_SQL = """
fin_raw AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         max(o_totalprice) AS income_number,
         count(*) AS loans_number,
         CAST(floor((min(o_totalprice) - 100000) / 20000) AS BIGINT) AS delay_number,
         CAST(floor(max(o_totalprice) / 20000) AS BIGINT) AS years_number,
         CAST(floor(min(o_totalprice) / 50000) AS BIGINT) AS months_number,
         CASE WHEN max(o_orderpriority) = '5-LOW' THEN 'Low' ELSE 'High' END AS spent_text,
         CASE min(o_orderstatus) WHEN 'F' THEN 'Small' WHEN 'O' THEN 'Medium' ELSE 'Huge' END AS value_text,
         CASE min(o_orderpriority) WHEN '1-URGENT' THEN '_' WHEN '2-HIGH' THEN 'Bad' ELSE 'Good' END AS credit_mix_raw,
         min(o_orderpriority) AS loan_a, max(o_orderpriority) AS loan_b, min(o_orderstatus) AS loan_c,
         CASE max(o_orderstatus) WHEN 'P' THEN 'NM' WHEN 'O' THEN 'Yes' ELSE 'No' END AS payment_of_min_amount
  FROM orders GROUP BY 1, 2),
fin_typed AS (
  SELECT *, CASE WHEN delay_number >= 0 THEN CAST(delay_number AS INTEGER) END AS delay_valid FROM fin_raw),
fin_ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY snapshot_date ORDER BY loans_number) AS loans_rank,
         row_number() OVER (PARTITION BY snapshot_date ORDER BY delay_valid NULLS LAST) AS delay_rank,
         count(*) OVER (PARTITION BY snapshot_date) AS loans_n,
         count(delay_valid) OVER (PARTITION BY snapshot_date) AS delay_n
  FROM fin_typed),
fin_caps AS (
  SELECT snapshot_date,
         max(loans_number) FILTER (WHERE loans_rank <= ceil(0.97::DOUBLE * loans_n)) AS loans_cap,
         max(delay_valid) FILTER (WHERE delay_rank <= ceil(0.97::DOUBLE * delay_n)) AS delay_cap
  FROM fin_ranked GROUP BY 1),
fin AS (
  SELECT customer_id, f.snapshot_date, income_number AS annual_income,
         CAST(least(loans_number, loans_cap) AS DOUBLE) AS num_of_loan,
         CASE WHEN delay_valid IS NOT NULL THEN CAST(least(delay_valid, delay_cap) AS DOUBLE) END AS delay_from_due_date,
         concat(years_number, ' Years and ', months_number, ' Months') AS credit_history_age,
         CAST(years_number AS INTEGER) AS credit_history_age_year,
         CAST(months_number AS INTEGER) AS credit_history_age_month,
         nullif(credit_mix_raw, '_') AS credit_mix,
         CASE WHEN value_text <> 'Huge' THEN spent_text END AS payment_behaviour_spent,
         CASE WHEN value_text <> 'Huge' THEN value_text END AS payment_behaviour_value,
         payment_of_min_amount
  FROM fin_typed f JOIN fin_caps c ON f.snapshot_date = c.snapshot_date),
loan_list AS (
  SELECT customer_id, snapshot_date, concat(loan_a, ', ', loan_b, ', and ', loan_c) AS type_of_loan,
         lower(replace(loan_a, ' ', '_')) AS token_a, lower(replace(loan_b, ' ', '_')) AS token_b, lower(loan_c) AS token_c
  FROM fin_raw)"""

# The words the loan lists of the stand-in are made of.
LOAN_TOKENS = ["1-urgent", "2-high", "3-medium", "4-not_specified", "5-low", "f", "o", "p"]

FIN_KINDS = {
    "annual_income": "number_double",
    "num_of_loan": "number_int",
    "delay_from_due_date": "number_int",
    "snapshot_date": "date",
}
FIN_CLIPPED = ("num_of_loan", "delay_from_due_date")


def raw_financials(t: Tables) -> DataFrame:
    """A written table, as a bronze table is: the cleaner reads it several times."""
    text = lambda c: c.cast("string")
    low, high = F.min("o_totalprice"), F.max("o_totalprice")
    status, urgent, lazy = F.min("o_orderstatus"), F.min("o_orderpriority"), F.max("o_orderpriority")
    last_status = F.max("o_orderstatus")
    size = F.when(status == "F", "Small").when(status == "O", "Medium").otherwise("Huge")
    raw = t.orders.groupBy(
        text(F.col("o_custkey")).alias("customer_id"),
        F.trunc("o_orderdate", "MM").alias("snapshot_date"),
    ).agg(
        F.concat(text(high), F.lit("_")).alias("annual_income"),
        F.concat(F.lit("_"), text(F.count(F.lit(1))), F.lit("_")).alias("num_of_loan"),
        text(F.floor((low - 100000) / 20000)).alias("delay_from_due_date"),
        F.concat(
            text(F.floor(high / 20000)), F.lit(" Years and "), text(F.floor(low / 50000)), F.lit(" Months")
        ).alias("credit_history_age"),
        F.concat(
            F.when(lazy == "5-LOW", "Low").otherwise("High"), F.lit("_spent_"), size, F.lit("_value_payments")
        ).alias("payment_behaviour"),
        F.when(urgent == "1-URGENT", "_").when(urgent == "2-HIGH", "Bad").otherwise("Good").alias("credit_mix"),
        F.concat(urgent, F.lit(", "), lazy, F.lit(", and "), status).alias("type_of_loan"),
        F.when(last_status == "P", "NM").when(last_status == "O", "Yes").otherwise("No").alias("payment_of_min_amount"),
    )
    return cut(raw, "raw-financials")


# ---- loan ledger: raw text per loan instalment

LMS_SQL = """
lms_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderdate AS DATE) AS loan_start_date, CAST(l_quantity AS INTEGER) AS tenure,
         l_linenumber AS installment_num, o_totalprice AS loan_amt, l_tax AS due_amt,
         l_extendedprice AS paid_amt, l_discount AS overdue_amt, o_totalprice AS balance,
         CAST(l_shipdate AS DATE) AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lms_missed AS (
  SELECT *, installment_num AS mob,
         CAST(coalesce(ceil(overdue_amt / nullif(due_amt, 0)), 0) AS INTEGER) AS installments_missed
  FROM lms_raw),
lms_first AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM lms_missed),
lms AS (
  SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                      ELSE 0 END AS INTEGER) AS dpd
  FROM lms_first),
labels_built AS (
  SELECT loan_id, customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
         '30dpd_6mob' AS label_def, snapshot_date
  FROM lms WHERE mob = 6)"""


def raw_lms(t: Tables) -> DataFrame:
    text = lambda name: F.col(name).cast("string")
    day = lambda name: F.col(name).cast("date").cast("string")
    # dealt by key: a table in few row groups would leave the join and the cleaning to as few tasks
    joined = t.lineitem.repartition("l_orderkey").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        text("l_orderkey").alias("loan_id"),
        text("o_custkey").alias("customer_id"),
        day("o_orderdate").alias("loan_start_date"),
        text("l_quantity").alias("tenure"),
        text("l_linenumber").alias("installment_num"),
        text("o_totalprice").alias("loan_amt"),
        text("l_tax").alias("due_amt"),
        text("l_extendedprice").alias("paid_amt"),
        text("l_discount").alias("overdue_amt"),
        text("o_totalprice").alias("balance"),
        day("l_shipdate").alias("snapshot_date"),
    )


# ---- clicks: facts per user and day; purchases are the anchors

CLICK_SQL = r"""
clicks AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, CAST(ts AS DATE) AS snapshot_date, event_type, CAST(round(value * 100) AS INTEGER) AS cents,
         CAST(regexp_extract(props, '([-+]?\d*\.?\d+)', 1) AS INTEGER) AS k
  FROM events),
anchors AS (SELECT customer_id, snapshot_date AS mob_date FROM clicks WHERE event_type = 'purchase'),
click_means AS (
  SELECT c.customer_id, round(avg(cents), 6) AS avg_cents, round(avg(k), 6) AS avg_k
  FROM clicks c JOIN anchors a ON c.customer_id = a.customer_id AND c.snapshot_date <= a.mob_date
  GROUP BY 1)"""


def clicks(t: Tables) -> DataFrame:
    from featuremart.functions.cleaning import first_number, to_int

    return t.events.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").cast("date").alias("snapshot_date"),
        "event_type",
        F.round(F.col("value") * 100).cast("int").alias("cents"),
        to_int(first_number(F.col("props"))).alias("k"),
    )


def loan_starts(t: Tables) -> DataFrame:
    """Purchases as ledger rows at month on book 0."""
    return t.events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit(0).alias("mob"),
        F.col("ts").cast("date").alias("snapshot_date"),
    )


# ---- scored rows: labelled documents, scored by their length

THRESHOLD = 0.32

SCORES_SQL = f"""
scores AS (
  SELECT l.doc_id, d.lang, d.source, l.quality AS actual_label,
         d.n_chars / (d.n_chars + 5000.0::DOUBLE) AS prediction_proba,
         CASE WHEN d.n_chars / (d.n_chars + 5000.0::DOUBLE) > {THRESHOLD}::DOUBLE THEN 1 ELSE 0 END AS prediction_binary
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def scores(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "lang", "source", "n_chars")
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(5000.0))
    return t.labels.join(docs, "doc_id").select(
        "doc_id",
        "lang",
        "source",
        F.col("quality").alias("actual_label"),
        score.alias("prediction_proba"),
        predicted_class(score, THRESHOLD).alias("prediction_binary"),
    )
