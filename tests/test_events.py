import datetime

import pytest
from pyspark.sql import functions as F

from deedflow import fields as f
from deedflow.operators import checks, events
from deedflow.operators.checks import ContractError

DIMENSIONS = "ListingKey string, City string, CountyOrParish string, PostalCode string, PropertySubType string"


@pytest.fixture(scope="module")
def listings(spark):
    rows = [
        ("a", " Napa ", "N", "94558.0", "", "2024-01-31", "9.5"),
        ("a", "Napa", "N", "94558", "SFR", "2024-02-01", None),
        (None, "", "N", None, "SFR", "2024-02-01", "x"),
        ("old", "Napa", "N", "94558", "SFR", "2023-12-31", "1"),
        ("undated", "Napa", "N", "94558", "SFR", None, "1"),
    ]
    return spark.createDataFrame(rows, f"{DIMENSIONS}, ListingContractDate string, ListPrice string").withColumn(
        "ClosePrice", F.lit(5.0)
    )


@pytest.fixture(scope="module")
def sold(spark):
    rows = [
        ("a", "Napa", "N", "94558", "SFR", datetime.date(2024, 2, 10), 100.0, 3, 0.5, 10.0),
        ("b", "Napa", "N", "94558", "SFR", datetime.date(2024, 2, 10), 200.0, 4, 0.499, 10.0),
        ("c", "Napa", "N", "94558", "SFR", datetime.date(2024, 2, 10), 300.0, 5, 1.5, 10.0),
        ("c", "Napa", "N", "94558", "SFR", datetime.date(2024, 2, 11), 300.0, 6, 1.501, 10.0),
        (None, "Napa", "N", "94558", "SFR", datetime.date(2024, 3, 10), None, 7, None, None),
        (None, "Napa", "N", "94558", "SFR", datetime.date(2023, 3, 10), None, 7, None, None),
    ]
    return spark.createDataFrame(
        rows,
        f"{DIMENSIONS}, CloseDate date, ClosePrice double, DaysOnMarket int, "
        "CloseToOriginalListRatio double, PricePerSqFt double",
    )


@pytest.fixture(scope="module")
def market(listings, sold):
    return events.market_events(listings, sold)


def test_schema_is_fixed(market):
    assert [(x.name, x.dataType) for x in market.schema] == [(x.name, x.dataType) for x in f.EVENT_SCHEMA]
    assert len(market.columns) == 23


def test_listing_rows(market):
    rows = market.filter(F.col("EventType") == f.NEW_LISTING).orderBy("EventDate", "ListingKey").collect()
    assert [r["EventMonth"] for r in rows] == [
        datetime.date(2024, 1, 1), datetime.date(2024, 2, 1), datetime.date(2024, 2, 1)
    ]
    first = rows[0]
    assert (first["City"], first["PostalCode"], first["PropertySubType"]) == ("Napa", "94558", None)
    assert (first["YrMo"], first["Year"], first["Month"], first["EventCount"]) == ("2024-01", 2024, 1, 1)
    assert (first["ListPrice"], first["ClosePrice"]) == (9.5, None)
    assert [r["ListPrice"] for r in rows[1:]] == [None, None]


def test_ratio_bounds(market, sold):
    rows = market.filter("EventType = 'Closed Sale'").orderBy("EventDate", "ListingKey").collect()
    assert [r["CloseToOriginalListRatio"] for r in rows] == [0.5, None, 1.5, None, None]
    assert [r["ClosePrice"] for r in rows] == [100.0, 200.0, 300.0, 300.0, None]
    report = events.ratio_cleaning(events.sale_events(sold)).first()
    assert tuple(report)[3:] == (5, 4, 1, 1, 1, 2, 2, 3, 40.0)
    empty = events.ratio_cleaning(events.sale_events(sold, "2030-01-01")).first()
    assert empty["valid_percent_after_cleaning"] == 0.0


def test_preparation_summary(listings, sold, market):
    got = {r["dataset"]: tuple(r)[1:] for r in events.preparation_summary(listings, sold, market).collect()}
    day = datetime.date
    assert got == {
        "new_listing_events": (5, 3, 2, day(2024, 1, 31), day(2024, 2, 1), 1, 1, 2),
        "closed_sale_events": (6, 5, 1, day(2024, 2, 10), day(2024, 3, 10), 3, 1, 2),
        "combined_events": (11, 8, 3, day(2024, 1, 31), day(2024, 3, 10), 3, 2, 4),
    }
    nothing = events.preparation_summary(listings, sold, market.limit(0)).first()
    assert (nothing["source_rows"], nothing["output_rows"], nothing["earliest_event_date"]) == (5, 0, None)


def test_duplicates_leave_missing_keys_out(spark, market):
    rows = events.duplicate_identity(market).collect()
    assert sorted((r["EventType"], r["ListingKey"], r["copies"]) for r in rows) == [
        ("Closed Sale", "c", 2), ("Closed Sale", "c", 2), ("New Listing", "a", 2), ("New Listing", "a", 2)
    ]
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert events.duplicate_identity(df, ["k"]).count() == 2


def test_a_hot_identity_is_spread(spark):
    rows = spark.range(20_000, numPartitions=4).selectExpr(
        "if(id % 10 < 9, 'hot', CAST(id AS string)) AS ListingKey",
        "if(id % 2 = 0, 'New Listing', 'Closed Sale') AS EventType", "id AS n")
    # Equal rows too: no column tells the copies apart.
    events_ = rows.unionByName(rows.limit(100)).drop("n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = events.duplicate_identity(events_)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) >= 18_000 and max(sizes) < 0.5 * sum(sizes)
        assert found.filter("ListingKey = 'hot'").select("EventType", "copies").distinct().count() == 2
    finally:
        for name in ("autoBroadcastJoinThreshold", "shuffle.partitions", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_coverage(market):
    rows = {(r["event_type"], r["field"]): r for r in events.field_coverage(market).collect()}
    assert len(rows) == 14
    assert tuple(rows["New Listing", "City"])[2:] == (3, 2, 1, 66.67)
    assert rows["New Listing", "ClosePrice"]["populated_rows"] == 0


def test_sorted_events(market):
    rows = events.sorted_events(market).collect()
    keys = [(r["EventDate"], r["EventType"], r["ListingKey"] is None, r["ListingKey"]) for r in rows]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1], k[2], k[3] or ""))


def test_monthly_market(market):
    rows = {r["EventMonth"]: tuple(r)[1:] for r in events.monthly_market(market).collect()}
    february = rows[datetime.date(2024, 2, 1)]
    assert february == (2, 4, 250.0, 4.5, 1.0)
    assert rows[datetime.date(2024, 1, 1)] == (1, 0, None, None, None)
    assert events.monthly_market(market, {"City": ["nowhere"]}).count() == 0


def test_contract(listings, sold, market):
    checks.enforce(checks.check(market, checks.event_checks(8)))
    with pytest.raises(ContractError, match="closed_sales_not_empty"):
        checks.enforce(checks.check(market.filter("EventType = 'New Listing'"), checks.event_checks(3)))
    early = events.market_events(listings, sold, "2023-01-01")
    with pytest.raises(ContractError, match=r"event_date_from_start \(2\)"):
        checks.enforce(checks.check(early, checks.event_checks(10)))
    odd = market.withColumn("ClosePrice", F.lit(1.0)).withColumn("EventCount", F.lit(2))
    with pytest.raises(ContractError, match="no_sold_measures.*event_count"):
        checks.enforce(checks.check(odd, checks.event_checks(8)))
    with pytest.raises(ContractError, match="PricePerSqFt"):
        events.sale_events(sold.drop("PricePerSqFt"))
