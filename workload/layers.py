"""Reading, slicing, writing, cleaning, clipping and parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.functions import cleaning as c
from featuremart.functions import parsing
from featuremart.operators.clipping import clip_above, fit_caps
from featuremart.operators.schema import declare, fill_numeric, lower_columns
from featuremart.operators.tokens import fit_tokens, long_token_counts, pivot_tokens
from featuremart.plans import gold, silver
from featuremart.sources import spine
from featuremart.sources.scratch import scratch_dir
from featuremart.sources.tables import (
    partition_counts,
    read_partitions,
    read_raw_csv,
    slice_snapshots,
    union_all,
    verify_content,
    verify_written,
    write_partitions,
)

from .registry import Tables, query
from .standins import (
    ATTR_SQL,
    FIN_CLIPPED,
    FIN_KINDS,
    FIN_SQL,
    LMS_SQL,
    LOAN_TOKENS,
    raw_attributes,
    raw_financials,
    raw_lms,
)

NUMBER = r"([-+]?\d*\.?\d+)"


def month_orders(t: Tables):
    return t.orders.withColumn("snapshot_date", F.trunc("o_orderdate", "MM"))


@query(
    "snapshot_slice",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date
FROM orders WHERE date_trunc('month', o_orderdate) BETWEEN DATE '1997-01-01' AND DATE '1998-12-01'""",
)
def snapshot_slice(t: Tables):
    source = scratch_dir(t.spark, "raw-orders")
    raw = month_orders(t).drop("o_orderdate")
    raw.toDF(*[n.upper() for n in raw.columns]).write.option("header", True).csv(source)
    dates = [f"{y}-{m:02d}-01" for y in (1997, 1998) for m in range(1, 13)]
    return slice_snapshots(lower_columns(read_raw_csv(t.spark, source)), dates)


@query(
    "partition_roundtrip",
    """
SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date
FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderpriority = '1-URGENT'""",
)
def partition_roundtrip(t: Tables):
    """Write all months, write the months of 1997 again with fewer rows, read everything back."""
    root = scratch_dir(t.spark, "orders")
    rows = month_orders(t).select("o_orderkey", "o_totalprice", "o_orderpriority", "snapshot_date")
    write_partitions(rows, root)
    again = rows.filter((F.year("snapshot_date") == 1997) & (F.col("o_orderpriority") == "1-URGENT"))
    write_partitions(again, root, dates=[f"1997-{m:02d}-01" for m in range(1, 13)])
    return read_partitions(t.spark, root)


@query(
    "partition_verify",
    "SELECT count(*) AS expected_rows, count(*) AS written_rows, true AS rows_match, true AS columns_match FROM orders",
)
def partition_verify(t: Tables):
    root = scratch_dir(t.spark, "orders-csv")
    rows = month_orders(t)
    write_partitions(rows, root, fmt="csv")
    return verify_written(t.spark, root, rows, fmt="csv")


@query(
    "partition_content",
    """
WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, year(o_orderdate) = 1996 AND o_orderkey % 89 = 0 AS lost,
         year(o_orderdate) = 1995 AND o_orderkey % 97 = 0 AS changed FROM orders)
SELECT snapshot_date, count(*) AS expected_rows, count(*) FILTER (WHERE NOT lost) AS written_rows,
       count(*) FILTER (WHERE lost) = 0 AS rows_match, count(*) FILTER (WHERE lost OR changed) = 0 AS content_matches
FROM m GROUP BY 1""",
)
def partition_content(t: Tables):
    """Months are written as text, checked by checksum, then some of them written again with a changed
    price or without some rows."""
    root = scratch_dir(t.spark, "orders-content")
    rows = month_orders(t)
    write_partitions(rows, root, fmt="csv")
    year, key, price = F.year("snapshot_date"), F.col("o_orderkey"), F.col("o_totalprice")
    again = rows.filter(year.isin(1995, 1996) & ~((year == 1996) & (key % 89 == 0)))
    again = again.withColumn("o_totalprice", F.when((year == 1995) & (key % 97 == 0), price + 1).otherwise(price))
    write_partitions(again, root, fmt="csv", dates=[f"{y}-{m:02d}-01" for y in (1995, 1996) for m in range(1, 13)], content=True)
    return verify_content(t.spark, root, rows, fmt="csv")


@query(
    "silver_dispatch",
    f"""
WITH {ATTR_SQL}, {FIN_SQL}, {LMS_SQL}
SELECT 'attributes' AS table_name, count(*) AS rows, count(age) AS filled FROM attr
UNION ALL SELECT 'clickstream', count(*), count(CASE WHEN event_type <> 'view' THEN value END) FROM events
UNION ALL SELECT 'financials', count(*), count(delay_from_due_date) FROM fin
UNION ALL SELECT 'loan_type', count(*), count(*) FILTER (WHERE token_a = '1-urgent' OR token_b = '1-urgent') FROM loan_list
UNION ALL SELECT 'lms', count(*), count(first_missed_date) FROM lms""",
)
def silver_dispatch(t: Tables):
    """Every table through its cleaner, found by the table's name."""
    day = F.lit("2024-01-01").alias("snapshot_date")
    click = F.when(F.col("event_type") != "view", F.col("value").cast("string"))
    fin = raw_financials(t)
    fin = fin.select("*", *[F.lit("1").alias(n) for n in silver.FINANCIALS if n not in fin.columns])
    raw = {
        "attributes": raw_attributes(t).withColumn("snapshot_date", day),
        "clickstream": t.events.select(*[click.alias(f"FE_{i}") for i in range(1, 21)], F.col("user_id").alias("Customer_ID"), day),
        "financials": fin,
        "lms": raw_lms(t),
    }
    filled = {
        "attributes": F.count("age"),
        "clickstream": F.count("fe_7"),
        "financials": F.count("delay_from_due_date"),
        "loan_type": F.count_if(F.col("`1-urgent`") > 0),
        "lms": F.count("first_missed_date"),
    }
    made = {n: df for table, df in raw.items() for n, df in silver.clean(table, df).items()}
    return union_all(
        *[df.agg(F.count(F.lit(1)).alias("rows"), filled[n].alias("filled")).withColumn("table_name", F.lit(n)) for n, df in made.items()]
    )


@query(
    "schema_drift_union",
    """
SELECT p_partkey, p_name, CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'SMALL') THEN p_size END AS p_size, p_type
FROM part""",
)
def schema_drift_union(t: Tables):
    """Partitions whose files lack a column, read as one table."""
    root = scratch_dir(t.spark, "parts")
    sized = F.col("p_type").isin("ECONOMY", "LARGE", "SMALL")
    write_partitions(t.part.filter(sized).select("p_partkey", "p_name", "p_size", "p_type"), root, by="p_type")
    write_partitions(t.part.filter(~sized).select("p_partkey", "p_name", "p_type"), root, by="p_type")
    return read_partitions(t.spark, root, merge_schema=True)


@query(
    "side_output_tables",
    f"""
WITH {FIN_SQL}
SELECT f.snapshot_date, count(*) AS financial_rows, 3 * count(*) AS loan_tokens,
       count(*) FILTER (WHERE token_a = '1-urgent' OR token_b = '1-urgent') AS urgent_rows
FROM fin f JOIN loan_list l ON f.customer_id = l.customer_id AND f.snapshot_date = l.snapshot_date
GROUP BY 1""",
)
def side_output_tables(t: Tables):
    """One input, two tables written; they are read back and joined."""
    root = scratch_dir(t.spark, "silver")
    tables = silver.clean_financials(raw_financials(t), kinds=FIN_KINDS, clipped=FIN_CLIPPED)
    write_partitions(tables.main, f"{root}/financials")
    write_partitions(tables.loan_type, f"{root}/loan_type")
    main = read_partitions(t.spark, f"{root}/financials").select("customer_id", "snapshot_date")
    loans = read_partitions(t.spark, f"{root}/loan_type")
    words = [n for n in loans.columns if n not in ("customer_id", "snapshot_date", "type_of_loan")]
    tokens = F.lit(0)
    for w in words:
        tokens = tokens + F.col(f"`{w}`")
    return (
        main.join(loans, ["customer_id", "snapshot_date"])
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("financial_rows"),
            F.sum(tokens).alias("loan_tokens"),
            F.count_if(F.col("`1-urgent`") > 0).alias("urgent_rows"),
        )
    )


@query(
    "date_spine",
    """
SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS DATE)
       AS snapshot_date
FROM orders""",
)
def date_spine(t: Tables):
    bounds = t.orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return spine.month_spine(bounds, "first", "last")


def present_partitions(t: Tables):
    """(table_name, snapshot_date, rows) of the months found in three tables."""
    dated = (("orders", t.orders, "o_orderdate"), ("lineitem", t.lineitem, "l_shipdate"), ("events", t.events, "ts"))
    return union_all(
        *[
            partition_counts(df.select(F.trunc(column, "MM").alias("snapshot_date"))).select(
                F.lit(name).alias("table_name"), "snapshot_date", "rows"
            )
            for name, df, column in dated
        ]
    )


def expected_partitions(t: Tables):
    """Every month from the first order to the last event, for each of the three tables."""
    bounds = union_all(
        t.orders.agg(F.min("o_orderdate").alias("first")), t.events.agg(F.max("ts").alias("last"))
    ).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    names = F.array(*map(F.lit, ("orders", "lineitem", "events")))
    return spine.month_spine(bounds, "first", "last").select(F.explode(names).alias("table_name"), "snapshot_date")


PARTITIONS_SQL = """
present AS (
  SELECT 'orders' AS table_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, count(*) AS n
  FROM orders GROUP BY ALL
  UNION ALL SELECT 'lineitem', CAST(date_trunc('month', l_shipdate) AS DATE), count(*) FROM lineitem GROUP BY ALL
  UNION ALL SELECT 'events', CAST(date_trunc('month', ts) AS DATE), count(*) FROM events GROUP BY ALL),
expected AS (
  SELECT table_name, snapshot_date
  FROM (SELECT unnest(['orders', 'lineitem', 'events']) AS table_name),
       (SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(o_orderdate) FROM orders)),
                                           (SELECT max(ts) FROM events), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date))"""


@query(
    "partition_completeness",
    f"WITH {PARTITIONS_SQL} SELECT table_name, snapshot_date FROM expected EXCEPT SELECT table_name, snapshot_date FROM present",
)
def partition_completeness(t: Tables):
    return spine.missing_partitions(expected_partitions(t), present_partitions(t), ["table_name", "snapshot_date"])


@query(
    "declared_cast",
    r"""
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(trunc(c_acctbal) AS INTEGER) AS whole, c_acctbal AS amount,
       CAST(c_custkey AS INTEGER) AS number_in_name, CAST(NULL AS DATE) AS not_a_date
FROM customer""",
)
def declared_cast(t: Tables):
    raw = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").cast("string").alias("whole"),
        F.concat(F.lit("$"), F.col("c_acctbal").cast("string")).alias("amount"),
        F.col("c_name").alias("number_in_name"),
        F.col("c_mktsegment").alias("not_a_date"),
    )
    kinds = {"id": "string", "whole": "int", "amount": "number_double", "number_in_name": "number_int", "not_a_date": "date"}
    return declare(raw, kinds)


CLICK_COLUMNS_SQL = ", ".join(f"CAST(trunc(value * {i}) AS INTEGER) AS fe_{i}" for i in range(1, 21))


@query(
    "clickstream_clean",
    f"SELECT {CLICK_COLUMNS_SQL}, CAST(user_id AS VARCHAR) AS customer_id, CAST(ts AS DATE) AS snapshot_date FROM events",
)
def clickstream_clean(t: Tables):
    raw = t.events.select(
        *[(F.col("value") * i).cast("string").alias(f"fe_{i}") for i in range(1, 21)],
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").cast("string").alias("snapshot_date"),
    )
    return silver.clean_clickstream(raw)


@query(
    "numeric_extract",
    rf"""
WITH dirty AS (
  SELECT c_custkey, concat('_', c_acctbal, '_') AS wrapped, c_name AS named, c_mktsegment AS words FROM customer)
SELECT c_custkey, regexp_extract(wrapped, '{NUMBER}', 1) AS wrapped_text,
       CAST(regexp_extract(wrapped, '{NUMBER}', 1) AS DOUBLE) AS wrapped_number,
       CAST(trunc(CAST(regexp_extract(wrapped, '{NUMBER}', 1) AS DOUBLE)) AS INTEGER) AS wrapped_whole,
       regexp_extract(named, '{NUMBER}', 1) AS named_text,
       nullif(regexp_extract(words, '{NUMBER}', 1), '') AS words_text
FROM dirty""",
)
def numeric_extract(t: Tables):
    wrapped = c.first_number(F.concat(F.lit("_"), F.col("c_acctbal").cast("string"), F.lit("_")))
    return t.customer.select(
        "c_custkey",
        wrapped.alias("wrapped_text"),
        c.to_double(wrapped).alias("wrapped_number"),
        c.to_int(wrapped).alias("wrapped_whole"),
        c.first_number(F.col("c_name")).alias("named_text"),
        c.first_number(F.col("c_mktsegment")).alias("words_text"),
    )


@query(
    "range_format_sentinel_rules",
    f"WITH {ATTR_SQL} SELECT a.*, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, DATE '2024-01-01' AS snapshot_date"
    " FROM attr a JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR)",
)
def range_format_sentinel_rules(t: Tables):
    raw = raw_attributes(t).withColumn("snapshot_date", F.lit("2024-01-01"))
    balance = t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"), c.non_negative(F.col("c_acctbal")).alias("balance")
    )
    return silver.clean_attributes(raw).join(balance, "customer_id")


CLIP_RANKS_SQL = """
ranked AS (
  SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS large_price,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date
  FROM orders),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY snapshot_date ORDER BY o_totalprice) AS r1,
         count(*) OVER (PARTITION BY snapshot_date) AS n1,
         row_number() OVER (PARTITION BY snapshot_date ORDER BY large_price NULLS LAST) AS r2,
         count(large_price) OVER (PARTITION BY snapshot_date) AS n2
  FROM ranked),
caps AS (
  SELECT snapshot_date, max(o_totalprice) FILTER (WHERE r1 <= ceil(0.97::DOUBLE * n1)) AS cap1,
         max(large_price) FILTER (WHERE r2 <= ceil(0.97::DOUBLE * n2)) AS cap2
  FROM ordered GROUP BY 1)"""


def clip_input(t: Tables):
    return month_orders(t).select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("large_price"),
        "snapshot_date",
    )


@query(
    "quantile_clip",
    f"""
WITH {CLIP_RANKS_SQL}
SELECT o_orderkey, least(o_totalprice, cap1) AS o_totalprice,
       CASE WHEN large_price > cap2 THEN cap2 ELSE large_price END AS large_price, r.snapshot_date
FROM ranked r JOIN caps c ON r.snapshot_date = c.snapshot_date""",
)
def quantile_clip(t: Tables):
    rows, columns = clip_input(t), ["o_totalprice", "large_price"]
    return clip_above(rows, fit_caps(rows, columns, exact=True), columns)


@query(
    "quantile_clip_approx",
    "SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date, true AS within_error FROM lineitem",
)
def quantile_clip_approx(t: Tables):
    """Caps from the sketch; the rank of each cap is counted and has to lie within the error."""
    rows = t.lineitem.select("l_extendedprice", F.trunc("l_shipdate", "MM").alias("snapshot_date"))
    caps = fit_caps(rows, ["l_extendedprice"], q=0.97, relative_error=0.01)
    price, cap = F.col("l_extendedprice"), F.col("cap")
    ranks = (
        rows.join(caps.withColumnRenamed("l_extendedprice", "cap"), "snapshot_date")
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(price < cap).alias("below"), F.count_if(price <= cap).alias("upto"))
    )
    lowest, highest = F.floor((0.97 - 0.01) * F.col("n")), F.ceil((0.97 + 0.01) * F.col("n"))
    within = (F.col("below") < highest) & (F.col("upto") >= lowest)
    return ranks.select("snapshot_date", within.alias("within_error"))


@query(
    "duration_parse",
    """
SELECT o_orderkey, CAST(floor(o_totalprice / 20000) AS INTEGER) AS years,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 50000) AS INTEGER) END AS months,
       CASE WHEN o_orderstatus <> 'P'
            THEN CAST(floor(o_totalprice / 20000) * 12 + floor(o_totalprice / 50000) AS INTEGER) END AS total_months
FROM orders""",
)
def duration_parse(t: Tables):
    """'N Years and M Months', where partly shipped orders lack the months."""
    years = F.floor(F.col("o_totalprice") / 20000).cast("string")
    months = F.floor(F.col("o_totalprice") / 50000).cast("string")
    whole = F.concat(years, F.lit(" Years and "), months, F.lit(" Months"))
    text = F.when(F.col("o_orderstatus") == "P", F.concat(years, F.lit(" Years"))).otherwise(whole)
    parsed = t.orders.select(
        "o_orderkey",
        parsing.duration_part(text, "Year").alias("years"),
        parsing.duration_part(text, "Month").alias("months"),
    )
    return parsed.withColumn("total_months", parsing.total_months(F.col("years"), F.col("months")))


@query(
    "code_split",
    """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 'Low' ELSE 'High' END END AS spent,
       CASE o_orderstatus WHEN 'F' THEN 'Small' WHEN 'O' THEN 'Large' END AS value
FROM orders""",
)
def code_split(t: Tables):
    size = F.when(F.col("o_orderstatus") == "F", "Small").when(F.col("o_orderstatus") == "O", "Large").otherwise("?")
    level = F.when(F.col("o_orderpriority") == "5-LOW", "Low").otherwise("High")
    code = F.concat(level, F.lit("_spent_"), size, F.lit("_value_payments"))
    return t.orders.select("o_orderkey", parsing.code_part(code, 1).alias("spent"), parsing.code_part(code, 2).alias("value"))


@query(
    "fill_and_rename",
    """
SELECT l_orderkey, l_linenumber AS mob, l_quantity, CASE WHEN l_tax > 0 THEN l_tax ELSE 0 END AS l_tax,
       CASE WHEN l_discount > 0 THEN l_discount ELSE 0 END AS l_discount, CAST(l_shipdate AS DATE) AS mob_date
FROM lineitem""",
)
def fill_and_rename(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
    )
    return fill_numeric(rows).withColumnsRenamed({"l_linenumber": "mob", "snapshot_date": "mob_date"}).drop("l_returnflag")


@query("loan_performance", f"WITH {LMS_SQL} SELECT * FROM lms")
def loan_performance(t: Tables):
    return silver.clean_lms(raw_lms(t))


@query(
    "unresolved_overdue",
    f"WITH {LMS_SQL} SELECT snapshot_date, count(*) FILTER (WHERE overdue_amt > 0 AND dpd IS NULL) AS rows FROM lms GROUP BY 1",
)
def unresolved_overdue(t: Tables):
    return silver.unresolved_overdue(silver.clean_lms(raw_lms(t)))


@query(
    "rejected_values",
    """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
       count(*) FILTER (WHERE o_orderstatus = 'P') + count(*) AS rejected_values
FROM orders GROUP BY 1""",
)
def rejected_values(t: Tables):
    """Prices that cannot be read, and priorities that are no dates."""
    price = F.col("o_totalprice").cast("string")
    raw = month_orders(t).select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("n/a "), price)).otherwise(price).alias("price"),
        F.col("o_orderpriority").alias("day"),
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
    )
    return silver.rejected_values(raw, {"price": "double", "day": "date"})


@query("financials_clean", f"WITH {FIN_SQL} SELECT * FROM fin")
def financials_clean(t: Tables):
    return silver.clean_financials(
        raw_financials(t), kinds=FIN_KINDS, clipped=FIN_CLIPPED, loan_types=LOAN_TOKENS, exact_caps=True
    ).main


@query("label_store", f"WITH {LMS_SQL} SELECT * FROM labels_built")
def label_store(t: Tables):
    return gold.build_labels(silver.clean_lms(raw_lms(t)), mob=6, days=30)


TOKENS_SQL = """
words AS (
  SELECT p_partkey, string_split(lower(concat(replace(p_type, ' ', '_'), ' ', p_name)), ' ') AS tokens
  FROM part),
counted AS (SELECT p_partkey, token, count(*) AS n FROM (SELECT p_partkey, unnest(tokens) AS token FROM words) GROUP BY ALL)"""


def part_lists(t: Tables):
    """Lists such as 'SMALL, red and widget'."""
    name = F.replace(F.col("p_name"), F.lit(" "), F.lit(" and "))
    return t.part.select("p_partkey", F.concat(F.col("p_type"), F.lit(", "), name).alias("list"))


@query(
    "token_frequency",
    f"WITH {TOKENS_SQL} SELECT p_partkey, token, CAST(n AS INTEGER) AS n FROM counted",
)
def token_frequency(t: Tables):
    return long_token_counts(part_lists(t), "list", ["p_partkey"])


# The words of the part names and types.
PART_WORDS = (
    "anvil blue bolt cold economy gear gizmo hot large medium new old plate promo red ring rod small standard widget"
).split()
PIVOT_SQL = ", ".join(
    f"CAST(coalesce(sum(n) FILTER (WHERE token = '{w}'), 0) AS INTEGER) AS {w}" for w in PART_WORDS
)


@query("token_pivot", f"WITH {TOKENS_SQL} SELECT p_partkey, {PIVOT_SQL} FROM counted GROUP BY 1")
def token_pivot(t: Tables):
    lists = part_lists(t)
    return pivot_tokens(lists, "list", fit_tokens(lists, "list")).drop("list")
