"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from deedflow import fields as f
from deedflow.functions.scalars import (
    postal_code, rounded, strip_text, to_flag, year_month,
)
from deedflow.operators import checks, date_formats, events, explore, features, outliers, quality, rates
from deedflow.operators.reports import fixed
from suite import proxies
from suite.proxies import EVENT_START, table, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUMBERS = ("ClosePrice", "OriginalListPrice", "LivingArea", "DaysOnMarket")
OUTLIER_FIELDS = tuple(f.OUTLIER_FLAGS)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, proxies.SOLD)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, proxies.LISTINGS)


def monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, proxies.RATES)
    return rates.monthly_average(rates.select_rates(raw, rate="rate_text"))


def enriched_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.enrich_monthly(sold(spark, sf_dir), monthly_rates(spark, sf_dir), "CloseDate")


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.engineer(sold(spark, sf_dir))


def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.exclusion_flags(outliers.iqr_flags(sold(spark, sf_dir)))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.market_events(listings(spark, sf_dir), engineered(spark, sf_dir), EVENT_START)


def round_to(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({name: rounded(name, digits) for name in columns})


# -- sources, unions, filters ------------------------------------------------


@query
def profile(spark, sf_dir):
    return quality.profile(table(spark, sf_dir, "orders"))


@query
def prefer_versions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", year_month(F.col("o_orderdate")).alias("month"), "o_orderstatus", "o_orderkey"
    )
    settled = F.col("o_orderstatus") == "F"
    return quality.pick_preferred(orders, ["o_custkey", "month"], [settled, F.col("o_orderkey")])


def _evolving(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    early = orders.filter(F.col("o_orderdate") < "1998-01-01").drop("o_orderpriority")
    late = orders.filter(F.col("o_orderdate") >= "1998-01-01")
    return early.withColumn("source_file", F.lit("early")), late.withColumn("source_file", F.lit("late"))


@query
def union_evolving(spark, sf_dir):
    return quality.union_by_name(_evolving(spark, sf_dir))


@query
def union_report(spark, sf_dir):
    return quality.union_report(quality.union_by_name(_evolving(spark, sf_dir)))


@query
def filter_counts(spark, sf_dir):
    return quality.filter_counts(sold(spark, sf_dir), F.col("PropertyType") == "Residential", "sold")


@query
def filter_equal(spark, sf_dir):
    return listings(spark, sf_dir).filter(F.col("PropertyType") == "Residential")


# -- missing values ----------------------------------------------------------


@query
def missingness(spark, sf_dir):
    return quality.missingness(sold(spark, sf_dir))


@query
def most_missing(spark, sf_dir):
    return quality.most_missing(quality.missingness(sold(spark, sf_dir)), 3)


@query
def prune_sparse(spark, sf_dir):
    wide = sold(spark, sf_dir).withColumn("Rare", F.when(F.col("DaysOnMarket") == -3, "x"))
    return quality.drop_columns(wide, quality.sparse_columns(quality.missingness(wide)))


@query
def category_counts(spark, sf_dir):
    return quality.category_counts(sold(spark, sf_dir), "PropertySubType")


# -- distributions -----------------------------------------------------------


@query
def numeric_summary(spark, sf_dir):
    return explore.numeric_summary(sold(spark, sf_dir), NUMBERS)


@query
def iqr_summary(spark, sf_dir):
    return outliers.iqr_summary(sold(spark, sf_dir), OUTLIER_FIELDS)


@query
def iqr_thresholds(spark, sf_dir):
    return outliers.iqr_thresholds(sold(spark, sf_dir), OUTLIER_FIELDS)


@query
def iqr_flags(spark, sf_dir):
    return outliers.iqr_flags(sold(spark, sf_dir)).select(
        "ListingKey", "PostalCode", "CloseDate", *f.OUTLIER_FLAGS.values(), f.ANY_OUTLIER_FLAG
    )


@query
def exclusion_filter(spark, sf_dir):
    return outliers.kept_rows(excluded(spark, sf_dir)).select(
        "ListingKey", *OUTLIER_FIELDS, f.ANY_OUTLIER_FLAG, f.BUSINESS_RULE_FLAG, f.EXCLUSION_FLAG
    )


@query
def before_after(spark, sf_dir):
    rows = sold(spark, sf_dir)
    bounds = fixed(outliers.iqr_bounds(rows, OUTLIER_FIELDS))
    return outliers.before_after(outliers.exclusion_flags(outliers.iqr_flags(rows, bounds=bounds.collect())), bounds=bounds)


@query
def price_vs_list(spark, sf_dir):
    return round_to(
        explore.share_vs_reference(sold(spark, sf_dir), "ClosePrice", "ListPrice"),
        ("above_percent", "at_percent", "below_percent"),
    )


@query
def field_center(spark, sf_dir):
    return round_to(explore.field_center(sold(spark, sf_dir), "DaysOnMarket"), ("mean", "median", "p95"))


@query
def close_before_listing(spark, sf_dir):
    return explore.rows_before(sold(spark, sf_dir), "CloseDate", "ListingContractDate")


@query
def top_groups(spark, sf_dir):
    return round_to(explore.top_groups(sold(spark, sf_dir), "City", "ClosePrice"), ("median",))


@query
def histogram(spark, sf_dir):
    return round_to(explore.histogram(sold(spark, sf_dir), "ClosePrice"), ("lower", "upper"))


@query
def boxplot(spark, sf_dir):
    return round_to(
        explore.boxplot(sold(spark, sf_dir), OUTLIER_FIELDS),
        ("q1", "median", "q3", "whisker_low", "whisker_high"),
    )


# -- rates -------------------------------------------------------------------


@query
def monthly_average(spark, sf_dir):
    return monthly_rates(spark, sf_dir)


@query
def enrich_monthly(spark, sf_dir):
    return enriched_sold(spark, sf_dir).select(
        "ListingKey", "CloseDate", "year_month", "rate_30yr_fixed"
    )


@query
def join_quality(spark, sf_dir):
    return rates.join_quality(sold(spark, sf_dir), enriched_sold(spark, sf_dir), "CloseDate", "sold")


@query
def unmatched_months(spark, sf_dir):
    return rates.unmatched_months(enriched_sold(spark, sf_dir), "sold")


# -- cleaning ----------------------------------------------------------------


def _twin(spark, sf_dir):
    return view(spark, sf_dir, proxies.TWIN).withColumnsRenamed({"base_col": "X", "twin_col": "X.1"})


@query
def coalesce_columns(spark, sf_dir):
    return quality.coalesce_redundant(_twin(spark, sf_dir))


@query
def redundant_report(spark, sf_dir):
    return quality.redundant_report(_twin(spark, sf_dir), "twin")


@query
def coerce_types(spark, sf_dir):
    return quality.coerce_types(view(spark, sf_dir, proxies.DIRTY), ["date_text"], ["num_text"])


@query
def coercion_report(spark, sf_dir):
    dirty = view(spark, sf_dir, proxies.DIRTY)
    return quality.coercion_report(dirty, "dirty", ["date_text", "absent_date"], ["num_text", "absent"])


def _ruled(spark, sf_dir):
    return quality.apply_rules(sold(spark, sf_dir))


@query
def invalid_rules(spark, sf_dir):
    return _ruled(spark, sf_dir).select(
        "ListingKey", *OUTLIER_FIELDS,
        *[rule.flag for rule in f.BUSINESS_RULES], f.ANY_INVALID_FLAG,
    )


@query
def invalid_counts(spark, sf_dir):
    return quality.invalid_report(_ruled(spark, sf_dir), "sold")


@query
def timeline_flags(spark, sf_dir):
    return quality.order_flags(sold(spark, sf_dir)).select("ListingKey", *f.TIMELINE_FLAGS)


@query
def flag_summary(spark, sf_dir):
    return quality.flag_summary(
        quality.order_flags(sold(spark, sf_dir)), f.TIMELINE_FLAGS, "sold"
    )


@query
def geo_flags(spark, sf_dir):
    return quality.geo_flags(view(spark, sf_dir, proxies.GEO)).select(
        "c_custkey", *f.GEO_FLAGS, f.FILLED_FLAG
    )


@query
def dataset_summary(spark, sf_dir):
    before = _twin(spark, sf_dir)
    return quality.dataset_summary(before, quality.coalesce_redundant(before), "twin")


@query
def parse_flags(spark, sf_dir):
    geo = view(spark, sf_dir, proxies.GEO)
    return geo.select(
        "c_custkey", to_flag(geo, "latfilled").alias("latfilled"), to_flag(geo, "lonfilled").alias("lonfilled")
    )


@query
def clean_text(spark, sf_dir):
    return sold(spark, sf_dir).select("ListingKey", strip_text(F.col("City")).alias("City"))


@query
def clean_postal(spark, sf_dir):
    return sold(spark, sf_dir).select("ListingKey", postal_code(F.col("PostalCode")).alias("PostalCode"))


# -- features ----------------------------------------------------------------


@query
def engineer_features(spark, sf_dir):
    rows = engineered(spark, sf_dir).select(
        "ListingKey", *f.METRICS,
        "invalid_listing_to_contract_days_flag", "invalid_contract_to_close_days_flag",
    )
    return round_to(rows, ("PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt"))


@query
def feature_summary(spark, sf_dir):
    return features.feature_summary(engineered(spark, sf_dir))


@query
def segment_summary(spark, sf_dir):
    return features.segment_summary(engineered(spark, sf_dir), "CountyOrParish")


@query
def segments_all(spark, sf_dir):
    return features.segment_summaries(engineered(spark, sf_dir))


@query
def sample_rows(spark, sf_dir):
    rows = features.sample_rows(engineered(spark, sf_dir))
    return round_to(rows, ("PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt"))


# -- events ------------------------------------------------------------------


@query
def market_events(spark, sf_dir):
    return round_to(all_events(spark, sf_dir), ("CloseToOriginalListRatio", "PricePerSqFt"))


@query
def sorted_events(spark, sf_dir):
    return events.sorted_events(all_events(spark, sf_dir)).select(
        "EventDate", "EventType", "ListingKey", "ListPrice"
    )


@query
def ratio_cleaning(spark, sf_dir):
    return events.ratio_cleaning(events.sale_events(engineered(spark, sf_dir), EVENT_START))


@query
def preparation_summary(spark, sf_dir):
    return events.preparation_summary(
        listings(spark, sf_dir), sold(spark, sf_dir), all_events(spark, sf_dir)
    )


@query
def duplicate_identity(spark, sf_dir):
    return events.duplicate_identity(all_events(spark, sf_dir)).select(
        "EventType", "ListingKey", "EventDate", "copies"
    )


@query
def field_coverage(spark, sf_dir):
    return events.field_coverage(all_events(spark, sf_dir))


MARKET_MEASURES = (
    "median_close_price", "average_days_on_market", "average_close_to_original_list_ratio",
)


@query
def monthly_market(spark, sf_dir):
    return round_to(events.monthly_market(all_events(spark, sf_dir)), MARKET_MEASURES, 10)


@query
def monthly_market_filtered(spark, sf_dir):
    shown = {"CountyOrParish": ["ASIA", "EUROPE"]}
    return round_to(events.monthly_market(all_events(spark, sf_dir), shown), MARKET_MEASURES, 10)


# -- contracts ---------------------------------------------------------------


@query
def event_contracts(spark, sf_dir):
    def dated(df, date):
        return df.filter(F.col(date) >= EVENT_START).agg(F.count("*").alias("n")).scalar()

    expected = dated(listings(spark, sf_dir), "ListingContractDate") + dated(sold(spark, sf_dir), "CloseDate")
    return checks.check(all_events(spark, sf_dir), checks.event_checks(expected, EVENT_START))


@query
def feature_contracts(spark, sf_dir):
    expected = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n")).scalar()
    return checks.check(engineered(spark, sf_dir), checks.feature_checks(expected))


@query
def outlier_contracts(spark, sf_dir):
    expected = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n")).scalar()
    return checks.check(excluded(spark, sf_dir), checks.outlier_checks(expected))


@query
def rate_contracts(spark, sf_dir):
    expected = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n")).scalar()
    return checks.check(enriched_sold(spark, sf_dir), checks.rate_checks(expected))


# -- wider inputs and contracts ----------------------------------------------


def rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, proxies.RICH)


@query
def segments_many(spark, sf_dir):
    # Rounded means of few doubles depend on their order; counts and medians of days do not.
    return features.segment_summaries(features.engineer(rich(spark, sf_dir))).select(
        "segment_field", "segment_value", "record_count", "closed_sales_count", "median_days_on_market",
        "median_listing_to_contract_days", "median_contract_to_close_days",
    )


@query
def invalid_rules_all(spark, sf_dir):
    return quality.apply_rules(rich(spark, sf_dir)).select(
        "ListingKey", "BedroomsTotal", "BathroomsTotalInteger",
        *[rule.flag for rule in f.INVALID_RULES], f.ANY_INVALID_FLAG,
    )


@query
def exclusion_earlier_flags(spark, sf_dir):
    flagged = outliers.iqr_flags(rich(spark, sf_dir)).withColumnRenamed("earlier_flag", "invalid_close_price_flag")
    return outliers.kept_rows(outliers.exclusion_flags(flagged)).select(
        "ListingKey", f.ANY_OUTLIER_FLAG, f.BUSINESS_RULE_FLAG, f.EXCLUSION_FLAG
    )


@query
def coerce_date_formats(spark, sf_dir):
    dirty = view(spark, sf_dir, proxies.DIRTY)
    return quality.coerce_types(dirty, ["date_text"], ["num_text"], ["MM/dd/yyyy"])


@query
def enrich_date_formats(spark, sf_dir):
    text = sold(spark, sf_dir).select("ListingKey", F.date_format("CloseDate", "MM/dd/yyyy").alias("CloseDate"))
    return rates.enrich_monthly(text, monthly_rates(spark, sf_dir), "CloseDate", ["MM/dd/yyyy"])


@query
def date_format_votes(spark, sf_dir):
    """How many values each format of dates reads, over text columns of three formats."""
    texts = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("month_first"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("day_first"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("packed"))
    return date_formats.format_votes(texts, texts.columns)


@query
def repeated_months(spark, sf_dir):
    """Keys that a unique right side of a join may not repeat."""
    raw = rates.select_rates(view(spark, sf_dir, proxies.RATES), rate="rate_text")
    return events.repeated_keys(raw.select(year_month(F.col("date")).alias("year_month")), ["year_month"])


@query
def fields_without_numbers(spark, sf_dir):
    wide = sold(spark, sf_dir).withColumn("Nothing", F.lit(None).cast("double"))
    thresholds = outliers.iqr_thresholds(wide, ["ClosePrice", "Nothing"])
    return thresholds.filter("non_missing_count = 0").select("field", "missing_count")


@query
def dropped_columns(spark, sf_dir):
    wide = sold(spark, sf_dir).withColumn("Rare", F.when(F.col("DaysOnMarket") == -3, "x"))
    return quality.dropped_report(spark, {"sold": quality.sparse_columns(quality.missingness(wide))})


@query
def unexpected_flags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return checks.unexpected_flags(orders, ["o_orderstatus", "o_orderpriority"])


@query
def reports_of_both(spark, sf_dir):
    reports = [
        quality.filter_counts(df, F.col("PropertyType") == "Residential", name)
        for name, df in (("sold", sold(spark, sf_dir)), ("listings", listings(spark, sf_dir)))
    ]
    return quality.union_by_name(reports)
