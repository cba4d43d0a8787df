"""Monthly reference rates and their join to listings and sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deedflow.functions.scalars import Formats, ref, rounded, to_date, to_double, year_month
from deedflow.operators.checks import require_columns, require_unique
from deedflow.operators.reports import count_if, report_rows, row_count

MONTH, RATE = "year_month", "rate_30yr_fixed"


def select_rates(
    raw: DataFrame, date: str = "observation_date", rate: str = "MORTGAGE30US", formats: Formats = ()
) -> DataFrame:
    """Observations with a readable date and rate."""
    require_columns(raw, (date, rate), "rate series")
    return raw.select(
        to_date(raw, date, formats).alias("date"), to_double(raw, rate).alias(RATE)
    ).dropna(subset=["date", RATE])


def monthly_average(rates: DataFrame) -> DataFrame:
    """Mean rate per month, rounded to four decimals."""
    return (
        rates.groupBy(year_month(F.col("date")).alias(MONTH))
        .agg(rounded(F.avg(RATE), 4).alias(RATE))
        .orderBy(MONTH)
    )


def require_rates(monthly: DataFrame) -> None:
    require_unique(monthly, [MONTH])


def enrich_monthly(
    df: DataFrame, monthly: DataFrame, date: str, formats: Formats = ()
) -> DataFrame:
    """Left join of the monthly rate on the month of `date`.

    `monthly` has one row per calendar month (see `require_rates`), which bounds
    the broadcast.
    """
    require_columns(df, [date])
    keyed = df.withColumn(MONTH, year_month(to_date(df, date, formats)))
    return keyed.join(F.broadcast(monthly.select(MONTH, RATE)), MONTH, "left").select(
        *[ref(name) for name in df.columns], MONTH, RATE
    )


def join_quality(before: DataFrame, enriched: DataFrame, date: str, dataset: str) -> DataFrame:
    """Row counts, unreadable dates, unmatched rates and the month range."""
    rows_before = before.agg(row_count().alias("n")).scalar()
    unmatched = count_if(F.col(RATE).isNull())
    return report_rows(enriched, [{
        "dataset": dataset,
        "date_column": date,
        "row_count_after": row_count(),
        "invalid_or_missing_date_rows": count_if(F.col(MONTH).isNull()),
        "unmatched_rate_rows": unmatched,
        "all_rows_matched": unmatched == 0,
        "earliest_year_month": F.min(MONTH),
        "latest_year_month": F.max(MONTH),
    }]).select(
        "dataset", "date_column", rows_before.alias("row_count_before"), "row_count_after",
        "invalid_or_missing_date_rows", "unmatched_rate_rows", "all_rows_matched",
        "earliest_year_month", "latest_year_month",
    )


def unmatched_months(enriched: DataFrame, dataset: str) -> DataFrame:
    """Months that occur in the data and have no rate."""
    return (
        enriched.filter(F.col(RATE).isNull() & F.col(MONTH).isNotNull())
        .select(F.lit(dataset).alias("dataset"), MONTH)
        .distinct()
        .orderBy(MONTH)
    )
