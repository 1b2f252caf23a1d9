"""Column expressions on edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featuremart.functions import cleaning as c
from featuremart.functions import loans, parsing, scores


def values(spark, rows, schema, expression):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_first_number(spark):
    raw = ["23_", "-500", "_", None, "34847.84_", "_-100_"]
    got = values(spark, raw, "x string", c.to_double(c.first_number(F.col("x"))))
    assert got == [23.0, -500.0, None, None, 34847.84, -100.0]


def test_large_numbers_keep_their_digits(spark):
    assert values(spark, ["24198062_"], "x string", c.to_double(c.first_number(F.col("x")))) == [24198062.0]


def test_to_int_takes_the_whole_part(spark):
    raw = ["12.5", "3.0", "-3.9", "99999999999", "", "x", None]
    assert values(spark, raw, "x string", c.to_int(F.col("x"))) == [12, 3, -3, None, None, None, None]


def test_age_range(spark):
    assert values(spark, [-1, 0, 120, 121], "x int", c.within(F.col("x"), *c.AGE_RANGE)) == [None, 0, 120, None]


def test_ssn(spark):
    raw = ["123-45-6789", "#F%$D@*&8", "123-45-67890", None]
    assert values(spark, raw, "x string", c.matching(F.col("x"), c.SSN_PATTERN)) == ["123-45-6789", None, None, None]


def test_sentinel(spark):
    raw = ["_______", "Lawyer", None]
    assert values(spark, raw, "x string", c.without(F.col("x"), c.EMPTY_OCCUPATION)) == [None, "Lawyer", None]


def test_non_negative(spark):
    assert values(spark, [-1, 0, None, 4], "x int", c.non_negative(F.col("x"))) == [None, 0, None, 4]


def test_duration(spark):
    raw = ["10 Years and 9 Months", "NA", "1 Year", None]
    pair = F.struct(parsing.duration_part(F.col("x"), "Year"), parsing.duration_part(F.col("x"), "Month"))
    assert [tuple(v) for v in values(spark, raw, "x string", pair)] == [(10, 9), (None, None), (1, None), (None, None)]


def test_spending_code(spark):
    raw = ["Low_spent_Small_value_payments", "!@9#%8", None]
    pair = F.struct(parsing.code_part(F.col("x"), 1), parsing.code_part(F.col("x"), 2))
    assert [tuple(v) for v in values(spark, raw, "x string", pair)] == [("Low", "Small"), (None, None), (None, None)]


def test_token_counts(spark):
    raw = ["Auto Loan, Not Specified, and Auto Loan", None, " , and ", "Payday Loan and Payday Loan\t"]
    got = values(spark, raw, "x string", parsing.token_counts(F.col("x")))
    assert got == [{"auto_loan": 2, "not_specified": 1}, {}, {}, {"payday_loan": 2}]


@pytest.mark.parametrize(
    "overdue, due, snapshot, missed, first, dpd",
    [
        (0.0, 100.0, "2023-07-01", 0, None, 0),
        (100.0, 100.0, "2023-07-01", 1, "2023-06-01", 30),
        (150.0, 100.0, "2023-07-01", 2, "2023-05-01", 61),
        (50.0, 0.0, "2023-07-01", 0, None, None),
        (10.0, 100.0, "2024-03-31", 1, "2024-02-29", 31),
    ],
)
def test_days_past_due(spark, overdue, due, snapshot, missed, first, dpd):
    df = spark.createDataFrame([(overdue, due, dt.date.fromisoformat(snapshot))], "o double, d double, s date")
    df = df.withColumn("m", loans.installments_missed(F.col("o"), F.col("d")))
    df = df.withColumn("f", loans.first_missed_date(F.col("s"), F.col("m")))
    row = df.withColumn("p", loans.days_past_due(F.col("o"), F.col("s"), F.col("f"))).first()
    assert (row["m"], row["f"] and row["f"].isoformat(), row["p"]) == (missed, first, dpd)


def test_label(spark):
    assert values(spark, [29, 30, None], "x int", loans.past_due_label(F.col("x"), 30)) == [0, 1, 0]
    assert values(spark, [1], "x int", loans.label_definition(30, 6)) == ["30dpd_6mob"]


def test_prediction_is_strictly_above(spark):
    assert values(spark, [0.5, 0.51, None], "x double", scores.predicted_class(F.col("x"), 0.5)) == [0, 1, None]


def test_grid_values():
    grid = scores.ThresholdGrid()
    got = grid.values()
    assert grid.size == len(got) == 80
    assert (got[15], got[22], got[79]) == (0.24999999999999992, 0.3199999999999999, 0.8899999999999996)


def test_count_below_equals_comparing_with_every_threshold(spark):
    grid = scores.ThresholdGrid()
    points = grid.values()
    near = [v + d for v in points for d in (-1e-15, 0.0, 1e-15)] + [-5.0, 0.0, 1.0, 0.0999, 0.9, 7.0]
    got = values(spark, near, "x double", grid.count_below(F.col("x")))
    assert got == [sum(t < v for t in points) for v in near]


@pytest.mark.parametrize(
    "tn, fp, fn, tp, expected",
    [
        (909, 147, 51, 395, (0.728782, 0.885650, 0.799595, 0.830637)),
        (948, 108, 69, 377, (0.777320, 0.845291, 0.809882, 0.823144)),
        (5, 0, 3, 0, (0.0, 0.0, 0.0, 0.0)),
        (5, 0, 0, 0, (0.0, 0.0, 0.0, 0.0)),
    ],
)
def test_rates(spark, tn, fp, fn, tp, expected):
    from featuremart.operators.metrics import with_rates

    df = spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")
    row = with_rates(df).first()
    got = (row["precision"], row["recall"], row["f1_score"], row["f15_score"])
    assert got == pytest.approx(expected, abs=1e-6)
