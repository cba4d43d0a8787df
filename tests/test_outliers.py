import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from deedflow import fields as f
from deedflow.operators import checks, explore, outliers
from deedflow.operators.checks import ContractError

FLAGS = {"x": "x_flag"}


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 100.0, None)], "x double")


def test_thresholds(spark, small):
    (row,) = outliers.iqr_thresholds(small, ["x"]).collect()
    assert (row["q1"], row["median"], row["q3"], row["lower_bound"], row["upper_bound"]) == (2, 3, 4, -1, 7)
    assert (row["non_missing_count"], row["missing_count"]) == (5, 1)
    assert (row["below_lower_bound"], row["above_upper_bound"], row["total_iqr_outliers"]) == (0, 1, 1)
    assert row["iqr_outlier_percent_of_non_missing"] == 20.0
    outliers.require_usable(outliers.iqr_thresholds(small, ["x"]))


def test_flags_skip_missing_values(small):
    flagged = outliers.iqr_flags(small, FLAGS).collect()
    assert [(r["x"], r["x_flag"], r[f.ANY_OUTLIER_FLAG]) for r in flagged] == [
        (1.0, False, False), (2.0, False, False), (3.0, False, False), (4.0, False, False),
        (100.0, True, True), (None, False, False),
    ]


def test_value_on_the_bound_is_no_outlier(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 7)], "x double")
    assert not any(r["x_flag"] for r in outliers.iqr_flags(df, FLAGS).collect())


def test_field_without_numbers(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    thresholds = outliers.iqr_thresholds(df, ["x"])
    assert thresholds.first()["iqr_outlier_percent_of_non_missing"] == 0.0
    with pytest.raises(ContractError, match="x"):
        outliers.require_usable(thresholds)
    assert [r["x_flag"] for r in outliers.iqr_flags(df, FLAGS).collect()] == [False, False]


def test_exclusion_reuses_earlier_flags(spark):
    df = spark.createDataFrame(
        [(None, 5.0, 1.0, "True"), (10.0, 5.0, 1.0, "False"), (10.0, 0.0, 1.0, None), (10.0, 5.0, -1.0, "no")],
        "ClosePrice double, LivingArea double, DaysOnMarket double, invalid_close_price_flag string",
    ).withColumn(f.ANY_OUTLIER_FLAG, F.lit(False))
    flagged = outliers.exclusion_flags(df)
    assert [r[f.EXCLUSION_FLAG] for r in flagged.collect()] == [True, False, True, True]
    assert outliers.kept_rows(flagged).count() == 1


def test_before_after(spark):
    rows = [(100.0, False), (200.0, False), (9000.0, True), (None, False)]
    df = spark.createDataFrame(rows, f"x double, {f.EXCLUSION_FLAG} boolean")
    full, kept = outliers.before_after(df, {"x": "median_x"}).collect()
    assert tuple(full) == ("full_flagged", 4, 0, 0.0, 200.0)
    assert tuple(kept) == ("filtered_analysis", 3, 1, 25.0, 150.0)


def test_outlier_contract(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0)] * 5, "ClosePrice double, LivingArea double, DaysOnMarket double"
    )
    flagged = outliers.exclusion_flags(outliers.iqr_flags(df))
    checks.enforce(checks.check(flagged, checks.outlier_checks(5)))
    with pytest.raises(ContractError, match="row_count_unchanged"):
        checks.enforce(checks.check(flagged, checks.outlier_checks(6)))
    wrong = flagged.withColumn(f.EXCLUSION_FLAG, F.lit(True))
    with pytest.raises(ContractError, match="exclusion_combines_flags.*kept_rows_not_empty"):
        checks.enforce(checks.check(wrong, checks.outlier_checks(5)))
    with pytest.raises(ContractError):
        checks.require_boolean(df, ["ClosePrice"])


def test_top_groups(spark):
    rows = [("few", 900.0)] * 9 + [("b", 50.0)] * 10 + [("a", 50.0)] * 10 + [("c", 70.0)] * 11
    rows += [(None, 1.0)] * 20 + [("few", None)] * 5
    df = spark.createDataFrame(rows, "g string, x double")
    got = [tuple(r) for r in explore.top_groups(df, "g", "x").collect()]
    assert got == [("c", 11, 70.0), ("a", 10, 50.0), ("b", 10, 50.0)]


@pytest.mark.parametrize("values", [
    [1.0] * 5,
    [0.0, 50.0],
    list(np.round(np.random.default_rng(3).lognormal(12, 1, 500), 2)),
    [0.1 * i for i in range(101)],
])
def test_histogram_is_that_of_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    rows = explore.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["lower"] for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r["upper"] for r in rows] == pytest.approx(edges[1:].tolist())


def test_histogram_without_values(spark):
    assert explore.histogram(spark.createDataFrame([(None,)], "x double"), "x").count() == 0


def test_boxplot(spark, small):
    row = explore.boxplot(small, ["x"]).first()
    assert tuple(row) == ("x", 2.0, 3.0, 4.0, 1.0, 4.0, 0, 1)


def test_summary_rounds_to_two_decimals(spark):
    values = pd.Series([1.0, 2.0, 4.0, 8.125])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = explore.numeric_summary(df, ["x"]).first()
    assert row["standard_deviation"] == np.round(values.std(), 2)
    assert row["max"] == 8.12
    assert row["p95"] == np.round(values.quantile(0.95), 2)


def test_shares_use_valid_pairs_only(spark):
    rows = [(2.0, 1.0), (1.0, 1.0), (1.0, 2.0), (1.0, 4.0), (None, 1.0), (1.0, 0.0), (1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert tuple(explore.share_vs_reference(df, "a", "b").first()) == (4, 25.0, 25.0, 50.0)


def test_rows_before_and_county(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-02"), (None, "2024-01-02")], "a string, b string")
    assert explore.rows_before(df, "a", "b").first()["rows"] == 1
    assert explore.county_field(df) is None
    assert explore.county_field(df.withColumn("County", F.lit("x"))) == "County"
