"""Label store and feature store."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import loans, parsing
from ..operators.encoding import WIDEST, fit_categories, one_hot
from ..operators.imputation import fit_means, impute_means
from ..operators.pairing import semi_join
from ..operators.pointintime import point_in_time_means
from ..operators.schema import numeric_columns, quoted
from ..sources.scratch import cut, scratch_scope
from ..sources.tables import SNAPSHOT, drop_partitions, has_partitions, read_partitions, write_partitions

# Columns that are encoded, averaged or dropped, and the label definition.
CATEGORICAL = (
    "occupation",
    "payment_of_min_amount",
    "credit_mix",
    "payment_behaviour_spent",
    "payment_behaviour_value",
)
CLICK_COLUMNS = tuple(f"fe_{i}" for i in range(1, 21))
NOT_FEATURES = ("name", "ssn", "type_of_loan", "credit_history_age")
LABEL_MOB, LABEL_DAYS = 6, 30
ANCHOR_MOB = 0


def build_labels(lms: DataFrame, mob: int = LABEL_MOB, days: int = LABEL_DAYS) -> DataFrame:
    """One label per loan at its month on book: 1 when at least ``days`` past due."""
    return lms.filter(F.col("mob") == mob).select(
        "loan_id",
        "customer_id",
        loans.past_due_label(F.col("dpd"), days).alias("label"),
        loans.label_definition(days, mob).alias("label_def"),
        SNAPSHOT,
    )


def join_profiles(
    attributes: DataFrame, financials: DataFrame, loan_type: DataFrame, labels: DataFrame
) -> DataFrame:
    """Labelled customers with their attributes, financials and loan counts per snapshot.

    Attributes are reduced to labelled customers before the wide joins.
    """
    on = ["customer_id", SNAPSHOT]
    base = semi_join(attributes, labels, ["customer_id"]).drop(*NOT_FEATURES)
    joined = base.join(financials.drop(*NOT_FEATURES), on=on, how="inner").join(
        loan_type.drop(*NOT_FEATURES), on=on, how="inner"
    )
    return joined.withColumn(
        "credit_history_age_month",
        parsing.total_months(F.col("credit_history_age_year"), F.col("credit_history_age_month")),
    ).drop("credit_history_age_year")


def click_averages(
    clickstream: DataFrame, lms: DataFrame, columns: Sequence[str] = CLICK_COLUMNS, anchor: str = "all"
) -> DataFrame:
    """Mean clicks per customer up to the start of a loan."""
    starts = lms.filter(F.col("mob") == ANCHOR_MOB)
    return point_in_time_means(
        clickstream, starts, "customer_id", SNAPSHOT, SNAPSHOT, columns, anchor=anchor
    )


def build_features(
    attributes: DataFrame,
    financials: DataFrame,
    loan_type: DataFrame,
    clickstream: DataFrame,
    lms: DataFrame,
    labels: DataFrame,
    fit_customers: DataFrame | None = None,
    impute_clicks: bool = True,
    click_columns: Sequence[str] = CLICK_COLUMNS,
    categorical: Sequence[str] = CATEGORICAL,
    anchor: str = "all",
    keep: bool = True,
) -> DataFrame:
    """One wide row per labelled customer and snapshot.

    ``fit_customers`` limits what the means and categories are learned from to those customers, so
    that later rows do not leak into training; without it all rows are used. ``impute_clicks=False``
    leaves the averages of customers without clicks null. ``keep`` writes the joined rows to scratch
    once, because fitting and encoding read them again.
    """
    return feature_forms(
        attributes, financials, loan_type, clickstream, lms, labels, fit_customers,
        impute_clicks, click_columns, categorical, anchor, keep,
    )[0]


def long_categories(df: DataFrame, vocabularies: Mapping[str, Sequence[str | None]]) -> DataFrame | None:
    """(customer, snapshot, column, category) of the columns whose values share an ``__other`` column in the
    wide form; None when every value has a column of its own. Nulls are no category."""
    shared = [c for c, values in vocabularies.items() if None in values]
    if not shared:
        return None
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("category")) for c in shared]
    long = df.select("customer_id", SNAPSHOT, F.explode(F.array(*pairs)).alias("p"))
    return long.select("customer_id", SNAPSHOT, "p.column", "p.category").filter(F.col("category").isNotNull())


def feature_forms(
    attributes: DataFrame,
    financials: DataFrame,
    loan_type: DataFrame,
    clickstream: DataFrame,
    lms: DataFrame,
    labels: DataFrame,
    fit_customers: DataFrame | None = None,
    impute_clicks: bool = True,
    click_columns: Sequence[str] = CLICK_COLUMNS,
    categorical: Sequence[str] = CATEGORICAL,
    anchor: str = "all",
    keep: bool = True,
    widest: int = WIDEST,
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of :func:`build_features`, and the :func:`long_categories` of columns with more than
    ``widest`` values."""
    joined = join_profiles(attributes, financials, loan_type, labels)
    clicks = click_averages(clickstream, lms, click_columns, anchor)
    joined = joined.join(clicks, on="customer_id", how="left")
    if keep:
        joined = cut(joined, "joined-features")
    fit_rows = joined if fit_customers is None else semi_join(joined, fit_customers, ["customer_id"])
    click_names = {f"avg_{c}" for c in click_columns}
    imputed = [
        c for c in numeric_columns(joined, ("customer_id",)) if impute_clicks or c not in click_names
    ]
    filled = impute_means(joined, fit_means(fit_rows, imputed))
    vocabularies = fit_categories(fit_rows, categorical, widest)
    return one_hot(filled, vocabularies), long_categories(joined, vocabularies)


def on_spine(df: DataFrame, dates: Iterable[str]) -> DataFrame:
    return df.filter(F.col(SNAPSHOT).isin(*[F.lit(d).cast("date") for d in dates]))


def write_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    dates: Sequence[str],
    fit_label_until: str | None = None,
    widest: int = WIDEST,
) -> tuple[DataFrame, DataFrame]:
    """Build both stores from silver and write the partitions of the given dates.

    Means and categories are learned from customers whose label is dated up to ``fit_label_until``;
    without it from all. Columns with more than ``widest`` values also go to ``feature_categories`` in
    long form, which names every value. Returns the stores read back from disk, so nothing is computed again.
    """
    silver = {
        t: read_partitions(spark, f"{silver_root}/{t}")
        for t in ("attributes", "financials", "loan_type", "clickstream", "lms")
    }
    labels = build_labels(silver["lms"])
    fit_customers = None
    if fit_label_until is not None:
        fit_customers = labels.filter(F.col(SNAPSHOT) <= F.lit(fit_label_until).cast("date"))
    with scratch_scope(spark):
        features, long = feature_forms(
            silver["attributes"],
            silver["financials"],
            silver["loan_type"],
            silver["clickstream"],
            silver["lms"],
            labels,
            fit_customers=fit_customers,
            widest=widest,
        )
        write_partitions(on_spine(features, dates), f"{gold_root}/feature_store", dates=dates)
        if long is not None:
            write_partitions(on_spine(long, dates), f"{gold_root}/feature_categories", dates=dates)
        elif has_partitions(spark, f"{gold_root}/feature_categories"):
            drop_partitions(spark, f"{gold_root}/feature_categories", dates, SNAPSHOT)
    write_partitions(on_spine(labels, dates), f"{gold_root}/label_store", dates=dates)
    return (
        read_partitions(spark, f"{gold_root}/feature_store", dates=dates),
        read_partitions(spark, f"{gold_root}/label_store", dates=dates),
    )
