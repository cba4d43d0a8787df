"""The long market-event table: one row per new listing and closed sale."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from deedflow import fields as f
from deedflow.functions.scalars import (
    Formats, is_true, month_start, percent, postal_code, ref, rounded, strip_text, to_date, to_double,
    year_month,
)
from deedflow.operators.checks import require_columns
from deedflow.operators.distribution import distribution
from deedflow.operators.reports import count_if, report_rows, row_count

RATIO = "CloseToOriginalListRatio"
KEY_PART, KEY_PARTS = "_key_part", 16


def _events(
    df: DataFrame, date: str, kind: str, start: str, required: Iterable[str], optional: Iterable[str],
    formats: Formats,
) -> DataFrame:
    require_columns(df, [*required, date], f"source of {kind} events")
    used = {*required, *(name for name in optional if name in df.columns)}
    day = to_date(df, date, formats)
    derived = {
        "EventType": F.lit(kind),
        "EventDate": day,
        "EventMonth": month_start(day),
        "Year": F.year(day),
        "Month": F.month(day),
        "YrMo": year_month(day),
        "EventCount": F.lit(1),
    }

    def column(field: T.StructField) -> Column:
        name = field.name
        if name in derived:
            value = derived[name]
        elif name not in used:
            value = F.lit(None)
        elif isinstance(field.dataType, T.DoubleType):
            value = to_double(df, name)
        elif name == "PostalCode":
            value = postal_code(ref(name).cast("string"))
        else:
            value = strip_text(ref(name).cast("string"))
        return value.cast(field.dataType).alias(name)

    return df.filter(day >= F.lit(start).cast("date")).select(
        *[column(field) for field in f.EVENT_SCHEMA]
    )


def listing_events(
    listings: DataFrame, start: str = f.EVENT_FLOOR, formats: Formats = ()
) -> DataFrame:
    return _events(
        listings, "ListingContractDate", f.NEW_LISTING, start, f.EVENT_DIMENSIONS, f.EVENT_OPTIONAL, formats
    )


def sale_events(sold: DataFrame, start: str = f.EVENT_FLOOR, formats: Formats = ()) -> DataFrame:
    """Closed-sale events with their ratios as they came."""
    return _events(
        sold, "CloseDate", f.CLOSED_SALE, start,
        (*f.EVENT_DIMENSIONS, *f.SOLD_MEASURES), f.EVENT_OPTIONAL, formats,
    )


def clean_ratio(
    events: DataFrame, column: str = RATIO, bounds: tuple[float, float] = f.RATIO_BOUNDS
) -> DataFrame:
    """Ratios outside the bounds become NULL; the row stays."""
    return events.withColumn(column, F.when(ref(column).between(*bounds), ref(column)))


def ratio_cleaning(
    sales: DataFrame, column: str = RATIO, bounds: tuple[float, float] = f.RATIO_BOUNDS
) -> DataFrame:
    """What `clean_ratio` removes from uncleaned sale events."""
    value = ref(column)
    below, above = count_if(value < bounds[0]), count_if(value > bounds[1])
    valid = count_if(value.between(*bounds))
    return report_rows(sales, [{
        "field": column,
        "lower_bound_inclusive": bounds[0],
        "upper_bound_inclusive": bounds[1],
        "sold_event_rows": row_count(),
        "non_missing_before_cleaning": F.count(value),
        "missing_before_cleaning": row_count() - F.count(value),
        "excluded_below_lower_bound": below,
        "excluded_above_upper_bound": above,
        "total_excluded_as_implausible": below + above,
        "valid_rows_after_cleaning": valid,
        "missing_after_cleaning": row_count() - valid,
        "valid_percent_after_cleaning": rounded(percent(valid, row_count()), 2),
    }])


def market_events(
    listings: DataFrame,
    sold: DataFrame,
    start: str = f.EVENT_FLOOR,
    bounds: tuple[float, float] = f.RATIO_BOUNDS,
    formats: Formats = (),
) -> DataFrame:
    """Both kinds of events in one table, in no particular order."""
    sales = clean_ratio(sale_events(sold, start, formats), bounds=bounds)
    return listing_events(listings, start, formats).unionByName(sales)


def sorted_events(events: DataFrame) -> DataFrame:
    """Events by date, type and key; the other columns settle ties.

    A range-partitioned sort for the final output only.
    """
    first = ["EventDate", "EventType", "ListingKey"]
    order = first + [name for name in events.columns if name not in first]
    return events.orderBy(*[F.asc_nulls_last(name) for name in order])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, NULL keys left out."""
    columns = [ref(name) for name in keys]
    return (
        df.dropna(subset=list(keys)).groupBy(*columns)
        .agg(row_count().alias("copies")).filter("copies > 1")
    )


def duplicate_identity(
    events: DataFrame, keys: Sequence[str] = ("EventType", "ListingKey")
) -> DataFrame:
    """Keep every copy of rows that share their keys, with the number of copies.

    The rows of a key are dealt over `KEY_PARTS` parts by their other columns and
    meet a copy of its count in each, so that a hot key is no hot task.
    """
    part = F.pmod(F.xxhash64(*[ref(name) for name in events.columns], F.monotonically_increasing_id()), F.lit(KEY_PARTS))
    dealt = events.withColumn(KEY_PART, part.cast("int"))
    repeated = repeated_keys(events, keys).withColumn(
        KEY_PART, F.explode(F.sequence(F.lit(0), F.lit(KEY_PARTS - 1)))
    )
    return dealt.join(repeated, [*keys, KEY_PART]).select(
        *[ref(name) for name in events.columns], "copies"
    )


def preparation_summary(listings: DataFrame, sold: DataFrame, events: DataFrame) -> DataFrame:
    """Source and output rows, date range, keys and repeated identities.

    Events are first reduced to one row per key, which serves the distinct and
    the duplicate counts of both kinds and of their union.
    """
    kinds = {"new": f.NEW_LISTING, "closed": f.CLOSED_SALE}
    per_kind = []
    for short, kind in kinds.items():
        date = F.when(F.col("EventType") == kind, F.col("EventDate"))
        per_kind += [
            count_if(F.col("EventType") == kind).alias(f"{short}_rows"),
            F.min(date).alias(f"{short}_first"),
            F.max(date).alias(f"{short}_last"),
        ]
    keyed = events.groupBy("ListingKey").agg(*per_kind)
    known = F.col("ListingKey").isNotNull()

    def total(shorts: Iterable[str], condition: Column = F.lit(True)) -> Column:
        """Rows of the kinds, each kind of a key counted where the condition holds."""
        counted = F.lit(0)
        for short in shorts:
            rows = F.col(f"{short}_rows")
            counted = counted + F.coalesce(F.sum(F.when(condition & (rows > 0), rows)), F.lit(0))
        return counted.cast("bigint")

    def repeated(shorts: Iterable[str]) -> Column:
        return sum(
            (total([s], known & (F.col(f"{s}_rows") > 1)) for s in shorts), F.lit(0)
        ).cast("bigint")

    def entry(dataset: str, shorts: Sequence[str]) -> dict[str, object]:
        present = F.greatest(*[F.col(f"{s}_rows") for s in shorts], F.lit(0)) > 0
        # least and greatest skip NULL, so a kind without events does not matter.
        none = F.lit(None).cast("date")
        return {
            "dataset": dataset,
            "output_rows": total(shorts),
            "earliest_event_date": F.least(*[F.min(f"{s}_first") for s in shorts], none),
            "latest_event_date": F.greatest(*[F.max(f"{s}_last") for s in shorts], none),
            "distinct_listing_keys": count_if(known & present),
            "missing_listing_keys": total(shorts, ~known),
            "duplicate_event_identity_rows": repeated(shorts),
        }

    new, closed = (
        source.agg(row_count().alias("n")).scalar() for source in (listings, sold)
    )
    source_rows = (
        F.when(F.col("dataset") == "new_listing_events", new)
        .when(F.col("dataset") == "closed_sale_events", closed)
        .otherwise(new + closed)
    )
    return report_rows(keyed, [
        entry("new_listing_events", ["new"]),
        entry("closed_sale_events", ["closed"]),
        entry("combined_events", ["new", "closed"]),
    ]).withColumn("source_rows", source_rows).select(
        "dataset", "source_rows", "output_rows",
        (F.col("source_rows") - F.col("output_rows")).alias(
            "rows_excluded_before_start_or_missing_date"
        ),
        "earliest_event_date", "latest_event_date", "distinct_listing_keys",
        "missing_listing_keys", "duplicate_event_identity_rows",
    )


def field_coverage(
    events: DataFrame, fields: Sequence[str] = f.COVERAGE_FIELDS, group: str = "EventType"
) -> DataFrame:
    """How far each field is populated, per group."""
    counts = events.groupBy(ref(group).alias("event_type")).agg(
        row_count().alias("row_count"),
        F.array(*[
            F.struct(F.lit(name).alias("field"), F.count(ref(name)).alias("populated_rows"))
            for name in fields
        ]).alias("fields"),
    )
    return counts.select("event_type", "row_count", F.inline("fields")).select(
        "event_type", "field", "row_count", "populated_rows",
        (F.col("row_count") - F.col("populated_rows")).alias("missing_rows"),
        rounded(percent(F.col("populated_rows"), F.col("row_count")), 2).alias("populated_percent"),
    )


def monthly_market(
    events: DataFrame, filters: Mapping[str, Sequence[str]] | None = None, method: str = "exact"
) -> DataFrame:
    """New listings, closed sales, median price, mean days and mean ratio per month.

    `filters` maps dimensions (city, county, postal code, subtype) to the values
    to keep.
    """
    for name, values in (filters or {}).items():
        events = events.filter(ref(name).isin(*values))
    def average(name: str) -> Column:
        return F.avg(F.nanvl(F.col(name), F.lit(None)))

    # Only the price needs its values ranked; the rest is one plain aggregation by month.
    counts = events.groupBy("EventMonth").agg(
        count_if(F.col("EventType") == f.NEW_LISTING).alias("new_listings"),
        count_if(F.col("EventType") == f.CLOSED_SALE).alias("closed_sales"),
        average("DaysOnMarket").alias("average_days_on_market"),
        average(RATIO).alias("average_close_to_original_list_ratio"),
    )
    priced = events.filter("ClosePrice IS NOT NULL")
    prices = distribution(priced, ["ClosePrice"], by=["EventMonth"], method=method).select(
        F.col("EventMonth").alias("_month"), F.col("median").alias("median_close_price"))
    # A row per month on either side.
    return counts.join(F.broadcast(prices), F.col("EventMonth").eqNullSafe(F.col("_month")), "left").select(
        "EventMonth", "new_listings", "closed_sales", "median_close_price",
        "average_days_on_market", "average_close_to_original_list_ratio",
    ).orderBy("EventMonth")
