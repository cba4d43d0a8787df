import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from deedflow.operators import checks, features, rates
from deedflow.operators.checks import ContractError

SOLD = (
    "ListingKey string, CountyOrParish string, ClosePrice double, OriginalListPrice double, "
    "LivingArea double, DaysOnMarket int, ListingContractDate string, PurchaseContractDate string, "
    "CloseDate string"
)
ROWS = [
    ("1", "A", 100.0, 80.0, 10.0, 5, "2024-01-10", "2024-01-09", "2024-02-01"),
    ("2", "A", 300.0, 0.0, 0.0, 7, "2024-01-10", "2024-01-10", "2024-01-10"),
    ("3", "B", None, 100.0, 10.0, 9, "2024-01-10", None, "2024-03-01"),
    ("4", None, 50.0, 100.0, -1.0, None, None, "2024-01-10", None),
]


@pytest.fixture(scope="module")
def sold(spark):
    return spark.createDataFrame(ROWS, SOLD)


def test_features(sold):
    rows = {r["ListingKey"]: r for r in features.engineer(sold).collect()}
    assert [rows[k]["PriceRatio"] for k in "1234"] == [1.25, None, None, 0.5]
    assert [rows[k]["PricePerSqFt"] for k in "1234"] == [10.0, None, None, None]
    assert [rows[k]["ListingToContractDays"] for k in "1234"] == [None, 0, None, None]
    assert [rows[k]["invalid_listing_to_contract_days_flag"] for k in "1234"] == [True, False, False, False]
    assert [rows[k]["ContractToCloseDays"] for k in "1234"] == [23, 0, None, None]
    assert [rows[k]["YrMo"] for k in "1234"] == ["2024-02", "2024-01", "2024-03", None]
    assert (rows["1"]["Year"], rows["1"]["Month"]) == (2024, 2)
    with pytest.raises(ContractError, match="LivingArea"):
        features.engineer(sold.drop("LivingArea"))


def test_feature_contract(sold):
    engineered = features.engineer(sold)
    checks.enforce(checks.check(engineered, checks.feature_checks(4)))
    bad = engineered.withColumn("PricePerSqFt", F.lit(float("inf"))).withColumn("YrMo", F.lit("2024"))
    with pytest.raises(ContractError, match="price_per_sq_ft_finite.*year_month_format"):
        checks.enforce(checks.check(bad, checks.feature_checks(4)))


def test_segments(sold):
    a, b = features.segment_summary(features.engineer(sold), "CountyOrParish").collect()
    assert (a["CountyOrParish"], a["record_count"], a["closed_sales_count"]) == ("A", 2, 2)
    assert (a["total_sales_volume"], a["average_close_price"], a["median_close_price"]) == (400.0, 200.0, 200.0)
    assert (b["CountyOrParish"], b["closed_sales_count"], b["total_sales_volume"]) == ("B", 0, 0.0)
    assert (b["average_close_price"], b["median_close_price"], b["median_days_on_market"]) == (None, None, 9.0)


def test_all_segments_equal_single_ones(sold):
    engineered = features.engineer(sold)
    every = features.segment_summaries(engineered, ["CountyOrParish", "ListingKey", "BuyerOfficeName"])
    for name in ("CountyOrParish", "ListingKey"):
        single = features.segment_summary(engineered, name)
        renamed = every.filter(F.col("segment_field") == name).drop("segment_field")
        assert sorted(map(tuple, renamed.collect()), key=str) == sorted(map(tuple, single.collect()), key=str)
    with pytest.raises(ContractError):
        features.segment_summaries(engineered, ["BuyerOfficeName"])


def test_feature_summary(sold):
    rows = {r["metric"]: r for r in features.feature_summary(features.engineer(sold)).collect()}
    assert tuple(rows["YrMo"])[1:] == (3, 1, 75.0, None, None, None, None)
    assert tuple(rows["PriceRatio"])[1:] == (2, 2, 50.0, 0.5, 0.88, 0.88, 1.25)


def test_sample(sold):
    engineered = features.engineer(sold.withColumn("ListingContractDate", F.lit("2024-01-01")))
    sample = features.sample_rows(engineered)
    assert sample.columns[:2] == ["ListingKey", "CountyOrParish"]
    assert [r["ListingKey"] for r in sample.collect()] == ["1"]
    with pytest.raises(ContractError):
        features.require_sample(features.sample_rows(engineered.filter("ListingKey = '3'")))


def test_monthly_average(spark):
    raw = spark.createDataFrame(
        [("2024-01-04", "6.62"), ("2024-01-04", "6.63"), ("2024-01-11", "."), ("bad", "7"), ("2024-02-01", "6")],
        "observation_date string, MORTGAGE30US string",
    )
    monthly = rates.monthly_average(rates.select_rates(raw))
    assert [tuple(r) for r in monthly.collect()] == [("2024-01", 6.625), ("2024-02", 6.0)]
    rates.require_rates(monthly)
    with pytest.raises(ContractError, match="empty"):
        rates.require_rates(monthly.limit(0))
    with pytest.raises(ContractError, match="unique"):
        rates.require_rates(monthly.unionByName(monthly))
    with pytest.raises(ContractError, match="MORTGAGE30US"):
        rates.select_rates(raw.drop("MORTGAGE30US"))


def test_enrich_keeps_rows_and_reports(spark, sold):
    monthly = spark.createDataFrame([("2024-01", 6.6), ("2024-02", 6.5)], "year_month string, rate_30yr_fixed double")
    enriched = rates.enrich_monthly(sold, monthly, "CloseDate")
    assert enriched.columns == [*sold.columns, "year_month", "rate_30yr_fixed"]
    assert [r["rate_30yr_fixed"] for r in enriched.orderBy("ListingKey").collect()] == [6.5, 6.6, None, None]
    row = rates.join_quality(sold, enriched, "CloseDate", "sold").first()
    assert tuple(row) == ("sold", "CloseDate", 4, 4, 1, 2, False, "2024-01", "2024-03")
    assert [tuple(r) for r in rates.unmatched_months(enriched, "sold").collect()] == [("sold", "2024-03")]
    report = checks.check(enriched, checks.rate_checks(4))
    with pytest.raises(ContractError, match=r"rate_matched \(2\)"):
        checks.enforce(report)
    with pytest.raises(ContractError):
        rates.enrich_monthly(sold, monthly, "absent")
