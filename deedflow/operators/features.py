"""Price ratios, calendar fields, durations and segment summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from deedflow import fields as f
from deedflow.functions.scalars import (
    Formats, is_true, percent, ratio, ref, rounded, to_date, to_double, year_month,
)
from deedflow.operators.checks import ContractError, require_columns, split_fields
from deedflow.operators.distribution import distribution, group_medians

NUMBERS = ("ClosePrice", "OriginalListPrice", "LivingArea", "DaysOnMarket")
DATES = ("CloseDate", "PurchaseContractDate", "ListingContractDate")


def elapsed_days(end: Column, start: Column) -> tuple[Column, Column]:
    """Days between two dates, NULL when negative, and the flag for that."""
    days = F.datediff(end, start)
    return F.when(days >= 0, days), is_true(days < 0)


def engineer(df: DataFrame, formats: Formats = ()) -> DataFrame:
    """Add ratios, calendar fields and durations; every row is kept."""
    require_columns(df, NUMBERS + DATES)
    typed = df.withColumns(
        {name: to_double(df, name) for name in NUMBERS} | {name: to_date(df, name, formats) for name in DATES}
    )
    close, purchase, listing = (F.col(name) for name in DATES)
    to_contract, bad_contract = elapsed_days(purchase, listing)
    to_close, bad_close = elapsed_days(close, purchase)
    original = ratio(F.col("ClosePrice"), F.col("OriginalListPrice"))
    return typed.withColumns({
        "PriceRatio": original,
        "CloseToOriginalListRatio": original,
        "PricePerSqFt": ratio(F.col("ClosePrice"), F.col("LivingArea")),
        "Year": F.year(close),
        "Month": F.month(close),
        "YrMo": year_month(close),
        "invalid_listing_to_contract_days_flag": bad_contract,
        "invalid_contract_to_close_days_flag": bad_close,
        "ListingToContractDays": to_contract,
        "ContractToCloseDays": to_close,
    })


def feature_summary(engineered: DataFrame, metrics: Sequence[str] = f.METRICS) -> DataFrame:
    """How far each metric is populated, with its range and centre.

    Text metrics have counts only.
    """
    text = [name for name in metrics if isinstance(engineered.schema[name].dataType, T.StringType)]
    described = {
        name: F.when(ref(name).isNotNull(), F.lit(0.0)) if name in text else to_double(engineered, name)
        for name in metrics
    }
    numeric = ~F.col("field").isin(*text) if text else F.lit(True)
    populated = F.col("non_missing_count")
    return distribution(engineered, described, moments=text).select(
        F.col("field").alias("metric"),
        populated.alias("populated_rows"),
        F.col("missing_count").alias("missing_rows"),
        rounded(percent(populated, F.col("row_count")), 2).alias("populated_percent"),
        *[
            F.when(numeric, rounded(source, 2)).alias(name)
            for source, name in (("min", "minimum"), ("median", "median"), ("mean", "mean"), ("max", "maximum"))
        ],
    )


SEGMENT_FIELDS = (
    "ClosePrice", "PricePerSqFt", "DaysOnMarket", "CloseToOriginalListRatio",
    "ListingToContractDays", "ContractToCloseDays",
)


VALUES = "_values"


def _packed(engineered: DataFrame) -> Column:
    """The described fields as one column: whatever a step reads of them, all steps share the scan's exchanges."""
    return F.array(*[to_double(engineered, name) for name in SEGMENT_FIELDS]).alias(VALUES)


def _segments(rows: DataFrame, keys: Sequence[str], method: str) -> DataFrame:
    """Counts, volume, means and medians per segment."""
    described = {name: F.get(VALUES, F.lit(i)) for i, name in enumerate(SEGMENT_FIELDS)}
    if method == "exact":
        summary = group_medians(rows, described, keys)
    else:
        summary = distribution(rows, described, by=keys, method=method).groupBy(*[ref(name) for name in keys]).agg(
            F.max("row_count").alias("row_count"), *[
                F.expr(f"max(if(field = '{name}', {source}, NULL))").alias(f"{measure}{i}")
                for i, name in enumerate(SEGMENT_FIELDS) for source, measure in (
                    ("non_missing_count", "_count"), ("total", "_total"), ("mean", "_mean"), ("median", "_median"))
            ])

    def of(field: str, measure: str) -> Column:
        return F.col(f"_{measure}{SEGMENT_FIELDS.index(field)}")

    def two(field: str, measure: str) -> Column:
        return rounded(of(field, measure), 2)

    return summary.select(
        *[ref(name) for name in keys],
        F.col("row_count").alias("record_count"),
        of("ClosePrice", "count").alias("closed_sales_count"),
        two("ClosePrice", "total").alias("total_sales_volume"),
        two("ClosePrice", "mean").alias("average_close_price"),
        two("ClosePrice", "median").alias("median_close_price"),
        two("PricePerSqFt", "mean").alias("average_price_per_sq_ft"),
        two("PricePerSqFt", "median").alias("median_price_per_sq_ft"),
        two("DaysOnMarket", "mean").alias("average_days_on_market"),
        two("DaysOnMarket", "median").alias("median_days_on_market"),
        two("CloseToOriginalListRatio", "mean").alias("average_close_to_original_list_ratio"),
        two("CloseToOriginalListRatio", "median").alias("median_close_to_original_list_ratio"),
        two("ListingToContractDays", "median").alias("median_listing_to_contract_days"),
        two("ContractToCloseDays", "median").alias("median_contract_to_close_days"),
    # Sampled for their order once exchanged, not computed twice for it.
    ).hint("rebalance", *[ref(name) for name in keys]).orderBy(
        F.desc("closed_sales_count"), F.desc("total_sales_volume"), *[ref(name) for name in keys]
    )


def segment_summary(engineered: DataFrame, segment: str, method: str = "exact") -> DataFrame:
    """Market measures per value of a segment; rows without one are left out."""
    rows = engineered.select(ref(segment), _packed(engineered)).filter(ref(segment).isNotNull())
    return _segments(rows, [segment], method)


def segment_summaries(
    engineered: DataFrame, segments: Sequence[str] = f.SEGMENTS, method: str = "exact"
) -> DataFrame:
    """The summaries of several segments from one plan."""
    available, _ = split_fields(engineered, segments)
    pairs = [
        part
        for name in available
        for part in (F.lit(name), ref(name).cast("string"))
    ]
    # Packed before the rows are unrolled.
    packed = engineered.select(*[ref(name) for name in available], _packed(engineered))
    long = packed.select(
        VALUES, F.stack(F.lit(len(available)), *pairs).alias("segment_field", "segment_value")
    ).filter("segment_value IS NOT NULL")
    return _segments(long, ["segment_field", "segment_value"], method)


def sample_rows(
    engineered: DataFrame, n: int = 10, metrics: Sequence[str] = f.METRICS,
    identifiers: Sequence[str] = f.SAMPLE_IDENTIFIERS,
) -> DataFrame:
    """First rows, by closing date, that have every metric."""
    shown = [name for name in identifiers if name in engineered.columns]
    columns = shown + [name for name in metrics if name not in shown]
    order = [name for name in ("CloseDate", "ListingKey") if name in columns]
    order += [name for name in columns if name not in order]
    return (
        engineered.dropna(subset=list(metrics))
        .select(*[ref(name) for name in columns])
        .orderBy(*[ref(name) for name in order])
        .limit(n)
    )


def require_sample(sample: DataFrame) -> None:
    if sample.isEmpty():
        raise ContractError("no row has every metric populated")
