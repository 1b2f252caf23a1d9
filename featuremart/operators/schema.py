"""Column names and declared types."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import cleaning as c

# How a declared kind reads its raw column.
KINDS = {
    "string": lambda x: x.cast("string"),
    "int": c.to_int,
    "double": c.to_double,
    "date": c.to_date,
    "number_int": lambda x: c.to_int(c.first_number(x)),
    "number_double": lambda x: c.to_double(c.first_number(x)),
}


def quoted(name: str) -> Column:
    """A top-level column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_columns(df: DataFrame) -> DataFrame:
    lowered = [name.lower() for name in df.columns]
    clashes = [name for name, n in Counter(lowered).items() if n > 1]
    if clashes:
        raise ValueError(f"columns differ only by case: {clashes}")
    return df.toDF(*lowered)


def declare(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Convert the named columns to their declared kinds in one projection; the rest pass through.

    Kinds: string, int, double, date, and number_int / number_double for the first number in dirty
    text.
    """
    missing = [name for name in kinds if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(
        *[
            KINDS[kinds[name]](quoted(name)).alias(name) if name in kinds else quoted(name)
            for name in df.columns
        ]
    )


def numeric_columns(df: DataFrame, except_for: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in except_for
    ]


def feature_columns(df: DataFrame, id_columns: tuple[str, ...] = ("customer_id", "snapshot_date")) -> list[str]:
    """Column names without the ids; an id the table lacks is ignored."""
    return [name for name in df.columns if name not in id_columns]


def fill_numeric(df: DataFrame, value=0, columns: list[str] | None = None) -> DataFrame:
    """Fill nulls of the given columns, by default of every numeric column."""
    return df.na.fill(value, subset=numeric_columns(df) if columns is None else columns)
