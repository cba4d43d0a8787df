"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from deedflow import fields as f
from deedflow.operators import events, explore, features, outliers, quality
from deedflow.operators.distribution import distribution
from deedflow.operators.reports import fixed
from suite.proxies import table
from suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scan_reads_the_described_columns_only(spark):
    text = plan(explore.numeric_summary(table(spark, SF_DIR, "lineitem"), ["l_tax"]))
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)) == {"struct<l_tax:double>"}


def test_event_floor_is_pushed_down(spark, tmp_path):
    columns = [*f.EVENT_DIMENSIONS, *f.SOLD_MEASURES]
    dates = ["DATE'2024-01-02' AS ListingContractDate", "DATE'2024-02-03' AS CloseDate"]
    rows = spark.range(3).selectExpr(*dates, *[f"'1' AS {name}" for name in columns])
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    for events_, date in ((events.listing_events, "ListingContractDate"), (events.sale_events, "CloseDate")):
        found = events_(stored, "2024-01-01")
        assert found.count() == 3
        assert f"GreaterThanOrEqual({date},2024-01-01)" in plan(found)


def test_whole_table_quantiles_shuffle_cells_only(spark):
    df = table(spark, SF_DIR, "lineitem")
    physical = plan(explore.numeric_summary(df, ["l_tax"])).split("== Physical Plan ==")[1]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", physical)
    assert exchanges and all("_field" in keys for keys in exchanges)
    assert "percentile" not in physical and "ObjectHashAggregate" not in physical


def test_groups_are_joined_without_a_hint(spark):
    df = table(spark, SF_DIR, "lineitem")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = plan(distribution(df, ["l_tax"], by=["l_returnflag"])).split("== Physical Plan ==")[1]
        assert "BroadcastHashJoin" not in physical and "SortMergeJoin" in physical
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_take_one_pass(spark):
    df = table(spark, SF_DIR, "lineitem")
    physical = plan(quality.missingness(df)).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1


def test_flags_need_no_join(spark):
    df = table(spark, SF_DIR, "lineitem")
    flagged = outliers.iqr_flags(df, {"l_tax": "tax_flag"})
    main = plan(flagged).split("== Physical Plan ==")[1].split("Subquery")[0]
    assert "Join" not in main


def executed_scans(df):
    """Scans of the plan that ran, those of reused exchanges left out."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = re.sub(r"\+- == Initial Plan ==.*?(?=\+- == Final Plan ==|\Z)", "", text, flags=re.S)
    return len(re.findall(r"FileScan", final))


def test_groups_and_single_scans_read_once(spark):
    df = table(spark, SF_DIR, "lineitem")
    assert executed_scans(distribution(df, ["l_tax", "l_discount"], by=["l_returnflag"])) == 1
    assert executed_scans(distribution(df, ["l_tax"], one_scan=True)) == 1
    assert executed_scans(explore.histograms(df, ["l_tax", "l_extendedprice"])) == 2


def test_before_after_reads_three_times(spark):
    df = table(spark, SF_DIR, "lineitem")
    bounds = outliers.iqr_bounds(df, ["l_extendedprice"])
    assert executed_scans(bounds) == 2
    flagged = outliers.exclusion_flags(
        outliers.iqr_flags(df, {"l_extendedprice": "price_flag"}, bounds=bounds.collect()), [])
    compared = outliers.before_after(flagged, {"l_extendedprice": "median_price"}, fixed(bounds))
    assert executed_scans(compared) == 1


def shuffled_records(df):
    """Records that the exchanges of the plan wrote, each exchange once."""
    df.collect()
    written, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec":
            written[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return sum(written.values())


def test_segments_shuffle_rows_not_values(spark):
    rows = 6000
    prices = {name: (F.col("id") * 7919 % (10_007 + i) + 0.37) for i, name in enumerate(features.SEGMENT_FIELDS)}
    df = spark.range(0, rows, 1, 2).withColumns(prices).withColumns({
        "MLSAreaMajor": F.col("id") % 900, "ListOfficeName": F.col("id") % 300, "PropertyType": F.lit("Residential")})
    segments = ["MLSAreaMajor", "ListOfficeName", "PropertyType"]
    # A row once per segment, and the loads, results and order of 1201 segments; six values a row were 18 and more.
    assert rows * len(segments) <= shuffled_records(features.segment_summaries(df, segments)) < 2 * rows * len(segments)
