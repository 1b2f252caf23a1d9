"""Time windows, exact stratified splits, and reports about them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut
from .schema import quoted


@dataclass(frozen=True)
class TimeWindows:
    """Inclusive bounds of the training and out-of-time windows before a training date."""

    train_start: date
    train_end: date
    oot_start: date
    oot_end: date

    @classmethod
    def before(cls, train_date: date, train_months: int = 12, oot_months: int = 3) -> "TimeWindows":
        oot_start = _minus_months(train_date, oot_months)
        return cls(
            train_start=_minus_months(oot_start, train_months),
            train_end=oot_start - timedelta(days=1),
            oot_start=oot_start,
            oot_end=train_date - timedelta(days=1),
        )


def _minus_months(d: date, months: int) -> date:
    """Same day ``months`` earlier, or the last day of that month."""
    year, month0 = divmod(d.year * 12 + d.month - 1 - months, 12)
    following = date(year + (month0 == 11), (month0 + 1) % 12 + 1, 1)
    last_day = (following - timedelta(days=1)).day
    return date(year, month0 + 1, min(d.day, last_day))


def window_name(c: Column, windows: TimeWindows) -> Column:
    """'train', 'oot', or 'none' for dates in neither window."""
    day = c.cast("date")
    return (
        F.when(day.between(F.lit(windows.train_start), F.lit(windows.train_end)), "train")
        .when(day.between(F.lit(windows.oot_start), F.lit(windows.oot_end)), "oot")
        .otherwise("none")
    )


def time_split(df: DataFrame, column: str, windows: TimeWindows, name: str = "split") -> DataFrame:
    return df.withColumn(name, window_name(F.col(column), windows))


def _shared(classes: DataFrame, of: str, draws: Column, name: str) -> DataFrame:
    """Column ``name``: ``draws`` shared among the classes in proportion to column ``of``, whole numbers
    by largest remainder, equal remainders by class name. Classes are summed and ranked here, not rows."""
    every = Window.partitionBy()
    exact = draws.cast("double") * F.col(of) / F.greatest(F.sum(of).over(every).cast("double"), F.lit(1.0))
    parts = classes.withColumn("_exact", exact).withColumn(name, F.floor("_exact").cast("long"))
    parts = parts.withColumn("_left", draws - F.sum(name).over(every)).withColumn("_over", F.col("_exact") - F.col(name))
    order = Window.orderBy(F.desc("_over"), F.col("_label").cast("string"))
    more = (F.row_number().over(order) <= F.col("_left")).cast("long")
    return parts.withColumn(name, F.col(name) + more).drop("_exact", "_left", "_over")


def stratified_sizes(classes: DataFrame, test_size: float = 0.2, val_size: float = 0.2) -> DataFrame:
    """``_label, n_test, n_val`` for classes ``_label, _n``. The test part is cut first; the validation part
    is cut from the rest with its share rescaled. Each part's total is rounded up. Totals are windows over
    the classes, so nothing runs before the result does."""
    total = F.sum("_n").over(Window.partitionBy())
    left = classes.withColumn("_draws", (total - F.ceil(F.lit(test_size) * total)).cast("long"))
    rest = _shared(left, "_n", F.col("_draws"), "_rest")
    kept = F.col("_draws") - F.ceil(F.lit(val_size / (1 - test_size)) * F.col("_draws"))
    train = _shared(rest.withColumn("_draws", kept.cast("long")), "_rest", F.col("_draws"), "_train")
    return train.selectExpr("_label", "_n - _rest AS n_test", "_rest - _train AS n_val")


def split_hash(key: Column, seed: int) -> Column:
    """Repeatable random order of the rows: it depends on seed and key only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "label",
    test_size: float = 0.2,
    val_size: float = 0.2,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Add a column 'test', 'val' or 'train' with exact class proportions.

    Rows are ordered within their class by :func:`split_hash`; the first are test, the next
    validation. Rows that share a key and class stay together, so the sizes are exact when ``key`` is
    unique. Only the hash at each cut is searched for: rows are counted by the first five digits, and the
    rows that share them with a cut, one of a million parts of a class, are ranked. Counts and cuts are
    written tables, whatever the number of classes. Assigning rows is a comparison with the cuts of their
    class; a row without a label is in no part (null).
    """
    hashed = df.select(quoted(label).alias("_label"), split_hash(quoted(key), seed).alias("_hash")).filter(
        F.col("_label").isNotNull()
    )
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, 5))
    counted = cut(hashed.groupBy("_label", "_prefix").agg(F.count(F.lit(1)).alias("_n")), "prefix-counts")
    classes = counted.groupBy("_label").agg(F.sum("_n").alias("_n"))
    sizes = stratified_sizes(classes, test_size, val_size)
    parts = {"test": F.col("n_test"), "val": F.col("n_test") + F.col("n_val")}
    last = F.array(*[F.struct(F.lit(p).alias("_part"), n.alias("_rank")) for p, n in parts.items()])
    ranks = sizes.select("_label", F.explode(last).alias("c")).select("_label", "c.*").filter("_rank > 0")
    at = _narrowed(counted, ranks)
    order = Window.partitionBy("_label", "_prefix").orderBy("_hash")
    inside = hashed.join(at, ["_label", "_prefix"], "left_semi").withColumn("_rank", F.row_number().over(order))
    found = inside.join(at, ["_label", "_prefix", "_rank"])
    hash_of = [F.max(F.when(F.col("_part") == p, F.col("_hash"))).alias(f"_{p}") for p in parts]
    cuts = cut(found.groupBy(F.col("_label").alias("_class")).agg(*hash_of), "cuts")

    placed = df.withColumn("_hash", split_hash(quoted(key), seed)).join(cuts, quoted(label) == F.col("_class"), "left")
    part = (
        F.when(quoted(label).isNull(), F.lit(None).cast("string"))
        .when(F.col("_hash") <= F.col("_test"), "test")
        .when(F.col("_hash") <= F.col("_val"), "val")
        .otherwise("train")
    )
    return placed.withColumn(name, part).drop("_hash", "_class", "_test", "_val")


def _narrowed(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The prefix that holds each wanted rank of a class, and the rank inside it."""
    before = F.sum("_n").over(Window.partitionBy("_label").orderBy("_prefix")) - F.col("_n")
    placed = counts.withColumn("_before", before).join(wanted, "_label")
    hit = F.col("_rank").between(F.col("_before") + 1, F.col("_before") + F.col("_n"))
    return placed.filter(hit).select("_label", "_part", "_prefix", (F.col("_rank") - F.col("_before")).cast("int").alias("_rank"))


def class_distribution(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("rows"))


def split_report(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and percentage per split. The few split rows are put in one array for their total, so
    the table is read once."""
    per_split = df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))
    gathered = per_split.agg(F.collect_list(F.struct(split, "rows")).alias("s"), F.sum("rows").alias("total"))
    return gathered.select(F.explode("s").alias("s"), "total").select(
        f"s.{split}", "s.rows", (F.col("s.rows") * 100.0 / F.col("total")).alias("percent")
    )
