"""Data contracts: conditions that must hold before results are published."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from deedflow import fields as f
from deedflow.functions.scalars import any_of, flag_word, is_finite, is_true, is_year_month, ref
from deedflow.functions.scalars import FALSE_WORDS, TRUE_WORDS
from deedflow.operators.reports import count_if, report_rows, row_count


class ContractError(ValueError):
    """A data contract does not hold."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> None:
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ContractError(f"{what} is missing required columns: {missing}")


def split_fields(df: DataFrame, wanted: Iterable[str]) -> tuple[list[str], list[str]]:
    """Fields the table has, and fields it lacks; none at all is an error."""
    wanted = list(wanted)
    available = [name for name in wanted if name in df.columns]
    if not available:
        raise ContractError(f"none of the fields {wanted} are available")
    return available, [name for name in wanted if name not in df.columns]


def require_boolean(df: DataFrame, flags: Iterable[str]) -> None:
    wrong = [name for name in flags if not isinstance(df.schema[name].dataType, T.BooleanType)]
    if wrong:
        raise ContractError(f"flags are not boolean: {wrong}")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Each key combination occurs once and the table is not empty."""
    columns = [ref(name) for name in keys]
    repeated = df.groupBy(*columns).count().agg(
        F.count(F.lit(1)).alias("keys"), F.max("count").alias("most")
    ).first()
    if not repeated["keys"]:
        raise ContractError("the table is empty")
    if repeated["most"] > 1:
        raise ContractError(f"the keys {list(keys)} are not unique")


def unexpected_flags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per flag column, up to five different values, in order, that are no boolean word.

    One aggregation: of each column the words are first made distinct, which
    partial aggregation does before anything is shuffled.
    """
    words = F.stack(F.lit(len(names)), *[part for name in names for part in (F.lit(name), flag_word(ref(name)))])
    bad = df.select(words.alias("field", "value")).filter(
        F.col("value").isNotNull() & ~F.col("value").isin(*TRUE_WORDS, *FALSE_WORDS)
    ).distinct()
    place = F.row_number().over(Window.partitionBy("field").orderBy("value"))
    return bad.withColumn("place", place).filter("place <= 5").select("field", "value").orderBy("field", "value")


def require_flags(df: DataFrame, names: Iterable[str]) -> None:
    text = [n for n in names if n in df.columns and not isinstance(df.schema[n].dataType, T.BooleanType)]
    values = defaultdict(list)
    for row in unexpected_flags(df, text).collect() if text else []:
        values[row["field"]].append(row["value"])
    if values:
        found = ", ".join(f"{name} holds unexpected boolean values: {words}" for name, words in values.items())
        raise ContractError(found)


def check(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """Rows of (check, violations, passed) from one aggregation.

    Each entry is an aggregate that counts violations.
    """
    return report_rows(df, [
        {"check": name, "violations": count.cast("bigint"), "passed": count == 0}
        for name, count in violations.items()
    ])


def check_counts(spark: SparkSession, violations: Mapping[str, int]) -> DataFrame:
    """The same rows from numbers that are known, such as those observed while a table was written."""
    rows = [(name, int(count), count == 0) for name, count in violations.items()]
    return spark.createDataFrame(rows, "check string, violations long, passed boolean")


def enforce(report: DataFrame) -> None:
    failed = [f"{row['check']} ({row['violations']})" for row in report.collect() if not row["passed"]]
    if failed:
        raise ContractError("checks failed: " + ", ".join(failed))


def rows_differ_from(expected: Column | int) -> Column:
    """Difference between the row count and an expected one."""
    return F.abs(row_count() - expected)


def is_empty_where(condition: Column) -> Column:
    """1 when no row meets the condition, else 0."""
    return F.when(count_if(condition) > 0, F.lit(0)).otherwise(F.lit(1))


def rate_checks(expected_rows: Column | int) -> dict[str, Column]:
    return {
        "row_count_unchanged": rows_differ_from(expected_rows),
        "rate_matched": count_if(F.col("rate_30yr_fixed").isNull()),
    }


def feature_checks(expected_rows: Column | int) -> dict[str, Column]:
    def infinite(name: str) -> Column:
        return count_if(F.col(name).isNotNull() & ~is_finite(F.col(name)))

    return {
        "row_count_unchanged": rows_differ_from(expected_rows),
        "ratios_identical": count_if(
            ~F.col("PriceRatio").eqNullSafe(F.col("CloseToOriginalListRatio"))
        ),
        "listing_to_contract_not_negative": count_if(F.col("ListingToContractDays") < 0),
        "contract_to_close_not_negative": count_if(F.col("ContractToCloseDays") < 0),
        "price_ratio_finite": infinite("PriceRatio"),
        "price_per_sq_ft_finite": infinite("PricePerSqFt"),
        "year_month_format": count_if(
            F.col("YrMo").isNotNull() & ~is_year_month(F.col("YrMo"))
        ),
    }


def outlier_checks(expected_rows: Column | int) -> dict[str, Column]:
    fields = any_of([F.col(name) for name in f.OUTLIER_FLAGS.values()])
    combined = F.col(f.ANY_OUTLIER_FLAG) | F.col(f.BUSINESS_RULE_FLAG)
    flags = [*f.OUTLIER_FLAGS.values(), f.ANY_OUTLIER_FLAG, f.BUSINESS_RULE_FLAG, f.EXCLUSION_FLAG]
    return {
        "row_count_unchanged": rows_differ_from(expected_rows),
        "flags_present": count_if(any_of([F.col(name).isNull() for name in flags])),
        "any_flag_combines_fields": count_if(~F.col(f.ANY_OUTLIER_FLAG).eqNullSafe(fields)),
        "exclusion_combines_flags": count_if(~F.col(f.EXCLUSION_FLAG).eqNullSafe(combined)),
        "kept_rows_not_empty": is_empty_where(~F.col(f.EXCLUSION_FLAG)),
    }


def event_checks(expected_rows: Column | int, start: str = f.EVENT_FLOOR) -> dict[str, Column]:
    kind = F.col("EventType")
    sold_on_listing = any_of([F.col(name).isNotNull() for name in f.SOLD_MEASURES])
    return {
        "new_listings_not_empty": is_empty_where(kind == f.NEW_LISTING),
        "closed_sales_not_empty": is_empty_where(kind == f.CLOSED_SALE),
        "row_count_reconciles": rows_differ_from(expected_rows),
        "event_date_present": count_if(F.col("EventDate").isNull()),
        "event_date_from_start": count_if(F.col("EventDate") < F.lit(start).cast("date")),
        "event_types_expected": count_if(~is_true(kind.isin(f.NEW_LISTING, f.CLOSED_SALE))),
        "no_sold_measures_on_listings": count_if((kind == f.NEW_LISTING) & sold_on_listing),
        "event_count_is_one": count_if(~F.col("EventCount").eqNullSafe(F.lit(1))),
    }
