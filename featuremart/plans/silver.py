"""Silver transforms: one cleaner per source table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as c
from ..functions import loans, parsing
from ..operators.clipping import clip_above, fit_caps
from ..operators.schema import KINDS, declare, fill_numeric, lower_columns, quoted
from ..operators.tokens import fit_tokens, pivot_tokens
from ..sources.scratch import cut, scratch_scope
from ..sources.quarantine import process_good
from ..sources.tables import SNAPSHOT, drop_partitions, partition_values, read_dates, write_partitions

# The declared columns of the source tables.
ATTRIBUTES = {
    "customer_id": "string",
    "name": "string",
    "age": "number_int",
    "ssn": "string",
    "occupation": "string",
    "snapshot_date": "date",
}
CLICKSTREAM = {
    **{f"fe_{i}": "int" for i in range(1, 21)},
    "customer_id": "string",
    "snapshot_date": "date",
}
FINANCIALS = {
    "annual_income": "number_double",
    "monthly_inhand_salary": "number_double",
    "num_bank_accounts": "number_int",
    "num_credit_card": "number_int",
    "interest_rate": "number_int",
    "num_of_loan": "number_int",
    "delay_from_due_date": "number_int",
    "num_of_delayed_payment": "number_int",
    "changed_credit_limit": "number_double",
    "num_credit_inquiries": "number_double",
    "outstanding_debt": "number_double",
    "credit_utilization_ratio": "number_double",
    "total_emi_per_month": "number_double",
    "amount_invested_monthly": "number_double",
    "monthly_balance": "number_double",
    "snapshot_date": "date",
}
LMS = {
    "loan_id": "string",
    "customer_id": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}
DECLARED = {"attributes": ATTRIBUTES, "clickstream": CLICKSTREAM, "financials": FINANCIALS, "lms": LMS}

NON_NEGATIVE = ("num_of_loan", "delay_from_due_date", "num_of_delayed_payment")
CLIPPED = ("num_bank_accounts", "num_credit_card", "interest_rate", "num_of_loan", "num_of_delayed_payment")
CLIP_QUANTILE = 0.97


def clean_attributes(df: DataFrame) -> DataFrame:
    return declare(df, ATTRIBUTES).withColumns(
        {
            "age": c.within(F.col("age"), *c.AGE_RANGE),
            "ssn": c.matching(F.col("ssn"), c.SSN_PATTERN),
            "occupation": c.without(F.col("occupation"), c.EMPTY_OCCUPATION),
        }
    )


def clean_clickstream(df: DataFrame) -> DataFrame:
    return declare(df, CLICKSTREAM)


class Financials(NamedTuple):
    """The cleaned table, and the loan lists that go to a table of their own."""

    main: DataFrame
    loan_type: DataFrame


def numbers_of_financials(df: DataFrame, kinds: Mapping[str, str] = FINANCIALS) -> DataFrame:
    """Typed columns with the non-negative rule applied; what the caps are fitted on."""
    typed = declare(df, kinds)
    return typed.withColumns({n: c.non_negative(F.col(n)) for n in NON_NEGATIVE if n in kinds})


def clean_financials(
    df: DataFrame,
    caps: DataFrame | None = None,
    loan_types: Sequence[str] | None = None,
    kinds: Mapping[str, str] = FINANCIALS,
    clipped: Sequence[str] = CLIPPED,
    q: float = CLIP_QUANTILE,
    exact_caps: bool = False,
) -> Financials:
    """Clean the financials of any number of snapshot dates at once.

    Caps are fitted per snapshot date and the loan vocabulary over the whole table, unless given. The raw
    text is parsed once: what is to be fitted on is written typed, and both tables are made from that.
    """
    typed = numbers_of_financials(df, kinds)
    if caps is None or loan_types is None:
        typed = cut(typed, "typed-financials")
    if caps is None:
        caps = fit_caps(typed, clipped, q, exact=exact_caps)
    history = F.col("credit_history_age")
    behaviour = F.col("payment_behaviour")
    main = (
        clip_above(typed, caps, clipped)
        .withColumns(
            {
                "credit_history_age_year": parsing.duration_part(history, "Year"),
                "credit_history_age_month": parsing.duration_part(history, "Month"),
                "payment_behaviour_spent": parsing.code_part(behaviour, 1),
                "payment_behaviour_value": parsing.code_part(behaviour, 2),
                "credit_mix": c.without(F.col("credit_mix"), c.EMPTY_CREDIT_MIX),
            }
        )
        .drop("payment_behaviour", "type_of_loan")
    )
    lists = typed.select("customer_id", SNAPSHOT, "type_of_loan")
    if loan_types is None:
        loan_types = fit_tokens(lists, "type_of_loan")
    return Financials(main, pivot_tokens(lists, "type_of_loan", loan_types))


def clean_lms(df: DataFrame, fill: Sequence[str] | None = None) -> DataFrame:
    """Loan performance per instalment: mob, installments_missed, first_missed_date, dpd.

    Numeric nulls become 0 before the days past due are derived: in every numeric column by default,
    or only in the columns of ``fill``.
    """
    typed = declare(df, LMS)
    with_missed = typed.withColumns(
        {
            "mob": F.col("installment_num"),
            "installments_missed": loans.installments_missed(F.col("overdue_amt"), F.col("due_amt")),
        }
    )
    filled = fill_numeric(with_missed, 0, list(fill) if fill is not None else None)
    return add_days_past_due(filled)


def add_days_past_due(df: DataFrame) -> DataFrame:
    """first_missed_date and dpd from installments_missed, overdue_amt and snapshot_date."""
    return df.withColumn(
        "first_missed_date", loans.first_missed_date(F.col(SNAPSHOT), F.col("installments_missed"))
    ).withColumn("dpd", loans.days_past_due(F.col("overdue_amt"), F.col(SNAPSHOT), F.col("first_missed_date")))


CLEANERS = {
    "attributes": clean_attributes,
    "clickstream": clean_clickstream,
    "financials": clean_financials,
    "lms": clean_lms,
}


#: Silver tables of a bronze table that has more than one.
SINKS = {"financials": ("financials", "loan_type")}


def clean(table: str, df: DataFrame, **fitted) -> dict[str, DataFrame]:
    """Silver tables made from one bronze table, by name. ``fitted`` goes to the table's cleaner."""
    if table not in CLEANERS:
        raise ValueError(f"no cleaner for table {table!r}; known: {sorted(CLEANERS)}")
    cleaned = CLEANERS[table](lower_columns(df), **fitted)
    if isinstance(cleaned, Financials):
        return {table: cleaned.main, "loan_type": cleaned.loan_type}
    return {table: cleaned}


def rejected_values(df: DataFrame, kinds: Mapping[str, str], by: str = SNAPSHOT) -> DataFrame:
    """Per partition, how many non-empty raw values could not be read as their declared kind."""
    typed = {n: k for n, k in kinds.items() if k != "string" and n != by}
    bad = [
        F.count_if((F.coalesce(F.trim(quoted(n).cast("string")), F.lit("")) != "") & KINDS[k](quoted(n)).isNull())
        for n, k in typed.items()
    ]
    total = bad[0]
    for b in bad[1:]:
        total = total + b
    return df.groupBy(c.to_date(F.col(by)).alias(by)).agg(total.alias("rejected_values"))


def unresolved_overdue(lms: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """Per partition, rows that are overdue without a due amount: their days past due are unknown."""
    return lms.groupBy(by).agg(F.count_if((F.col("overdue_amt") > 0) & F.col("dpd").isNull()).alias("rows"))


def _same_vocabulary(
    spark: SparkSession, bronze: str, silver_root: str, own: Sequence[str], fmt: str
) -> Sequence[str | None] | None:
    """The loan types that the stored dates other than ``own`` have columns for, if those of ``own`` are
    among them; an empty list if they are not; None if no other date is stored."""
    stored = f"{silver_root}/loan_type"
    others = sorted(set(partition_values(spark, stored)) - set(own))
    if not others:
        return None
    ids = ("customer_id", SNAPSHOT, "type_of_loan")
    rest = "type_of_loan__other"
    columns = [n for n in read_dates(spark, stored, others[:1]).columns if n not in ids]
    known = [None if n == rest else n for n in columns]
    found = fit_tokens(lower_columns(read_dates(spark, bronze, own, fmt)), "type_of_loan")
    return known if None in known or set(found) <= set(known) else []


def write_silver(
    spark: SparkSession,
    table: str,
    bronze_root: str,
    silver_root: str,
    dates: Sequence[str] | None = None,
    fmt: str = "parquet",
    content: bool = False,
) -> dict[str, str]:
    """Clean one bronze table for all the dates in one plan and write its silver tables.

    Bronze is laid out by date and cleaning does not shuffle, so neither does the write. A date that can't
    be read or cleaned is set aside and loses its silver partitions; the others are written. Gives the
    reasons by date. When only some dates are written, the loan types keep the columns of the stored
    dates; a loan type that these lack makes all dates be written again.
    """
    path = f"{bronze_root}/{table}"
    there = partition_values(spark, path)
    wanted = there if dates is None else [d for d in dates if d in set(there)]
    gone = set(dates or ()) - set(wanted)

    def probe(own: Sequence[str]) -> None:
        with scratch_scope(spark):
            for df in clean(table, read_dates(spark, path, own, fmt)).values():
                df.write.format("noop").mode("overwrite").save()

    def write(own: Sequence[str]) -> None:
        fitted = {}
        if table == "financials":
            types = _same_vocabulary(spark, path, silver_root, own, fmt)
            if types:
                fitted["loan_types"] = types
            elif types is not None:
                own = sorted({*own, *partition_values(spark, f"{silver_root}/{table}")})
        with scratch_scope(spark):
            for name, df in clean(table, read_dates(spark, path, own, fmt), **fitted).items():
                write_partitions(df, f"{silver_root}/{name}", rebalance=False, dates=own, content=content)

    bad = process_good(wanted, write, probe) if wanted else {}
    for name in SINKS.get(table, (table,)):
        drop_partitions(spark, f"{silver_root}/{name}", gone | set(bad))
    return bad
