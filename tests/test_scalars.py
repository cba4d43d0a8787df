import datetime

import pytest
from pyspark.sql import functions as F

from deedflow.fields import NA_TOKENS
from deedflow.functions import scalars as s
from deedflow.operators.checks import ContractError, require_flags, unexpected_flags


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def apply(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_postal_code(spark):
    texts = [" 92101.0", "92101-1234", "CA 9021", "123456", "   ", "K1A 0B1", None]
    assert apply(column(spark, texts), s.postal_code(F.col("x"))) == [
        "92101", "92101", "CA 9021", "12345", None, "K1A 0B1", None
    ]


def test_strip_text_takes_any_whitespace(spark):
    texts = ["\t a b\n", " x ", " ", "", None]
    assert apply(column(spark, texts), s.strip_text(F.col("x"))) == ["a b", "x", None, None, None]


def test_text_to_double(spark):
    texts = [" 12.5 ", "1e3", "+5", ".5", "5.", "1,000", "1d", "abc", "NaN", "inf", "1e999", "", None]
    assert apply(column(spark, texts), s.text_to_double(F.col("x"))) == [
        12.5, 1000.0, 5.0, 0.5, 5.0, None, None, None, None, None, None, None, None
    ]


def test_nan_is_missing(spark):
    df = column(spark, [1.0, float("nan"), None, float("inf")], "double")
    assert apply(df, s.to_double(df, "x")) == [1.0, None, None, float("inf")]


def test_timestamps(spark):
    texts = ["2024-01-15", "2024-01-15 23:30:00", "2024-02-30", "2024-01", "2024", "01/15/2024", None]
    day = datetime.datetime(2024, 1, 15)
    late = datetime.datetime(2024, 1, 15, 23, 30)
    df = column(spark, texts)
    assert apply(df, s.to_timestamp(df, "x")) == [day, late, None, None, None, None, None]
    assert apply(df, s.to_timestamp(df, "x", ["MM/dd/yyyy"])) == [day, late, None, None, None, day, None]


def test_calendar(spark):
    df = column(spark, [datetime.date(2024, 3, 9), None], "date")
    assert apply(df, s.year_month(F.col("x"))) == ["2024-03", None]
    assert apply(df, s.month_start(F.col("x"))) == [datetime.date(2024, 3, 1), None]


def test_month_token(spark):
    df = column(spark, ["/a/Sold202401.csv", "/a/Sold202402_filled.csv", "/a/notes.csv"])
    assert apply(df, s.month_token(F.col("x"))) == ["202401", "202402", None]


def test_parse_flag(spark):
    df = column(spark, ["TRUE", " no ", "1", None, "0", "Yes"])
    assert apply(df, s.parse_flag(F.col("x"))) == [True, False, True, False, False, True]


def test_unexpected_flags(spark):
    df = column(spark, ["true", "maybe", "x", "maybe", None])
    found = unexpected_flags(df.withColumn("y", F.lit("no")), ["x", "y"]).collect()
    assert [tuple(row) for row in found] == [("x", "maybe"), ("x", "x")]
    with pytest.raises(ContractError, match="maybe"):
        require_flags(df, ["x"])
    require_flags(df, ["absent"])


def test_equal_as_numbers_or_text(spark):
    pairs = [("100000", "100000.5"), ("1", "1.1"), (None, "1"), ("x", "x"), ("1", "1.0"), (None, None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert apply(df, s.equal_as_numbers_or_text(F.col("a"), F.col("b"))) == [True, False, False, True, True, False]


def test_ratio_needs_a_positive_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, -5.0), (1.0, 4.0)], "a double, b double")
    assert apply(df, s.ratio(F.col("a"), F.col("b"))) == [None, None, None, 0.25]


@pytest.mark.parametrize("value", [0.125, 0.375, 1.015, 2.675, -0.125, 1234.565, 0.285])
def test_rounding_is_that_of_numpy(spark, value):
    import numpy as np

    df = column(spark, [value], "double")
    assert apply(df, s.rounded(F.col("x"), 2)) == [float(np.round(value, 2))]


def test_na_tokens(spark):
    df = column(spark, [*NA_TOKENS, "na", " NA", "x"])
    assert apply(df, s.na_to_null(F.col("x")))[-3:] == ["na", " NA", "x"]
    assert set(apply(df, s.na_to_null(F.col("x")))[:-3]) == {None}


def test_finite_and_year_month_format(spark):
    df = column(spark, [1.0, float("inf"), float("nan")], "double")
    assert apply(df, s.is_finite(F.col("x"))) == [True, False, False]
    df = column(spark, ["2024-01", "2024-1", "x2024-01"])
    assert apply(df, s.is_year_month(F.col("x"))) == [True, False, False]
