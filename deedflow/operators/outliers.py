"""Interquartile-range outliers and the analysis copy without them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from deedflow import fields as f
from deedflow.functions.scalars import any_of, is_true, percent, ref, rounded, to_double, to_flag
from deedflow.operators.checks import ContractError
from deedflow.operators.distribution import distribution
from deedflow.operators.quality import is_invalid
from deedflow.operators.reports import count_if, report_rows, row_count

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
TAILS = {"p01": 0.01, "p05": 0.05, "p95": 0.95, "p99": 0.99}


def with_fences(df: DataFrame, factor: float = f.IQR_FACTOR) -> DataFrame:
    """Add the range and the outlier bounds to rows that carry q1 and q3."""
    spread = F.col("q3") - F.col("q1")
    return df.withColumns({
        "iqr": spread,
        "lower_bound": F.col("q1") - factor * spread,
        "upper_bound": F.col("q3") + factor * spread,
    })


def iqr_bounds(
    df: DataFrame,
    fields: Sequence[str],
    factor: float = f.IQR_FACTOR,
    quantiles: Mapping[str, float] = QUARTILES,
) -> DataFrame:
    """Quantiles and outlier bounds, one row per field."""
    return with_fences(distribution(df, fields, quantiles), factor)


def field_values(report: DataFrame | Sequence[Row], fields: Sequence[str], columns: Sequence[str]) -> Column:
    """A per-field report as one value: a struct with a struct per field.

    Used as a scalar subquery, so that rows are compared with it without a join; collected rows become constants.
    """
    if not isinstance(report, DataFrame):
        rows = {row["field"]: row for row in report}
        return F.struct(*[
            F.struct(*[F.lit(rows[name][column]).cast("double").alias(column) for column in columns]).alias(f"f{i}")
            for i, name in enumerate(fields)
        ])
    per_field = [
        F.max(F.when(F.col("field") == name, F.struct(*columns))).alias(f"f{i}")
        for i, name in enumerate(fields)
    ]
    return report.agg(*per_field).select(F.struct("*").alias("fields")).scalar()


def outside(value: Column, bounds: Column) -> tuple[Column, Column]:
    """Whether a value is below and above its bounds; NULL is neither."""
    below = is_true(value < bounds.getField("lower_bound"))
    above = is_true(value > bounds.getField("upper_bound"))
    return below, above


def fence_report(df: DataFrame, bounds: DataFrame | Sequence[Row], fields: Sequence[str]) -> DataFrame:
    """Values below and above the bounds, and the outermost values within them, one row per field."""
    limits = field_values(bounds, fields, ("lower_bound", "upper_bound"))
    values = df.select(*[to_double(df, name).alias(name) for name in fields], limits.alias("_limits"))
    rows = []
    for i, name in enumerate(fields):
        below, above = outside(ref(name), F.col("_limits").getField(f"f{i}"))
        rows.append({
            "field": name,
            "below_lower_bound": count_if(below),
            "above_upper_bound": count_if(above),
            "least_within": F.min(F.when(~below, ref(name))),
            "largest_within": F.max(F.when(~above, ref(name))),
        })
    return report_rows(values, rows)


def outlier_counts(df: DataFrame, bounds: DataFrame | Sequence[Row], fields: Sequence[str]) -> DataFrame:
    """Values below and above the bounds, one row per field."""
    return fence_report(df, bounds, fields).select("field", "below_lower_bound", "above_upper_bound")


def _with_counts(df: DataFrame, bounds: DataFrame, fields: Sequence[str], counted: DataFrame) -> DataFrame:
    # Both sides have one row per field.
    total = F.col("below_lower_bound") + F.col("above_upper_bound")
    return bounds.join(F.broadcast(counted), "field").withColumns({
        "total_outliers": total,
        "outlier_percent": percent(total, F.col("non_missing_count")),
    })


def iqr_summary(
    df: DataFrame, fields: Sequence[str], factor: float = f.IQR_FACTOR, bounds: DataFrame | None = None,
    fences: DataFrame | None = None,
) -> DataFrame:
    """Bounds and outlier counts, rounded to two decimals.

    `bounds` (`iqr_bounds`) and `fences` (`fence_report`) save computing them again.
    """
    if bounds is None:
        bounds = iqr_bounds(df, fields, factor, {"q1": 0.25, "q3": 0.75})
    counted = _with_counts(
        df, bounds, fields, outlier_counts(df, bounds, fields) if fences is None else fences)
    return counted.select(
        "field",
        rounded("lower_bound", 2).alias("iqr_lower_bound"),
        rounded("upper_bound", 2).alias("iqr_upper_bound"),
        "below_lower_bound",
        "above_upper_bound",
        F.col("total_outliers").alias("total_potential_outliers"),
        rounded("outlier_percent", 2).alias("potential_outlier_percent"),
    )


def iqr_thresholds(
    df: DataFrame, fields: Sequence[str], factor: float = f.IQR_FACTOR, bounds: DataFrame | None = None
) -> DataFrame:
    """Quantiles, bounds and outlier counts, rounded to four decimals.

    `bounds` saves computing them again (see `iqr_bounds`).
    """
    if bounds is None:
        bounds = iqr_bounds(df, fields, factor, QUARTILES | TAILS)
    counted = _with_counts(df, bounds, fields, outlier_counts(df, bounds, fields))
    measures = ("q1", "median", "q3", "iqr", "lower_bound", "upper_bound", *TAILS)
    return counted.select(
        "field",
        "non_missing_count",
        "missing_count",
        *[rounded(name, 4).alias(name) for name in measures],
        "below_lower_bound",
        "above_upper_bound",
        F.col("total_outliers").alias("total_iqr_outliers"),
        rounded("outlier_percent", 4).alias("iqr_outlier_percent_of_non_missing"),
    )


def require_usable(thresholds: DataFrame) -> None:
    """Every field has at least one number."""
    empty = [row["field"] for row in thresholds.filter("non_missing_count = 0").collect()]
    if empty:
        raise ContractError(f"fields without usable numbers: {empty}")


def iqr_flags(
    df: DataFrame, flags: Mapping[str, str] = f.OUTLIER_FLAGS, factor: float = f.IQR_FACTOR,
    bounds: DataFrame | Sequence[Row] | None = None,
) -> DataFrame:
    """Outlier flag per field and for any of them; every row is kept.

    Bounds that were collected enter as constants, others as a scalar subquery.
    """
    fields = list(flags)
    typed = df.withColumns({name: to_double(df, name) for name in fields})
    if bounds is None:
        bounds = iqr_bounds(typed, fields, factor)
    limits = field_values(bounds, fields, ("lower_bound", "upper_bound"))
    flagged = typed.withColumn("_limits", limits).withColumns({
        flag: any_of(outside(ref(name), F.col("_limits").getField(f"f{i}")))
        for i, (name, flag) in enumerate(flags.items())
    })
    return flagged.drop("_limits").withColumn(
        f.ANY_OUTLIER_FLAG, any_of([F.col(flag) for flag in flags.values()])
    )


def exclusion_flags(df: DataFrame, rules: Iterable[f.Rule] = f.BUSINESS_RULES) -> DataFrame:
    """Business-rule flag, from earlier flags or the values, and the exclusion flag."""
    rules = list(rules)
    earlier = [to_flag(df, rule.flag) for rule in rules if rule.flag in df.columns]
    broken = any_of([*earlier, *[is_invalid(rule) for rule in rules]])
    return df.withColumn(f.BUSINESS_RULE_FLAG, broken).withColumn(
        f.EXCLUSION_FLAG, F.col(f.ANY_OUTLIER_FLAG) | F.col(f.BUSINESS_RULE_FLAG)
    )


def kept_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col(f.EXCLUSION_FLAG))


def before_after(
    flagged: DataFrame, fields: Mapping[str, str] | None = None, bounds: DataFrame | None = None
) -> DataFrame:
    """Rows and medians of the full and of the filtered table.

    `bounds` (see `iqr_bounds`) of the full table, with medians, save describing it again. The kept rows are
    read once: flags are dear to compute, and the values of three fields are few.
    """
    fields = fields or {
        "ClosePrice": "median_close_price",
        "LivingArea": "median_living_area",
        "DaysOnMarket": "median_days_on_market",
    }
    full = distribution(flagged, list(fields)) if bounds is None else bounds.filter(F.col("field").isin(*fields))
    kept = distribution(kept_rows(flagged), list(fields), one_scan=True)
    measures = ("field", "row_count", "median")
    summary = full.select(F.lit("full").alias("part"), *measures).unionByName(
        kept.select(F.lit("kept").alias("part"), *measures))

    def of(part: str, measure: str, name: str | None = None) -> Column:
        chosen = F.col("part") == part
        return F.max(F.when(chosen if name is None else chosen & (F.col("field") == name), F.col(measure)))

    def medians(part: str) -> dict[str, Column]:
        return {alias: rounded(of(part, "median", name), 2) for name, alias in fields.items()}

    total, remaining = of("full", "row_count"), of("kept", "row_count")
    removed = total - remaining
    return report_rows(summary, [
        {
            "dataset": "full_flagged",
            "row_count": total,
            "rows_removed_from_full": F.lit(0).cast("bigint"),
            "percent_removed_from_full": F.lit(0.0),
            **medians("full"),
        },
        {
            "dataset": "filtered_analysis",
            "row_count": remaining,
            "rows_removed_from_full": removed,
            "percent_removed_from_full": rounded(percent(removed, total), 2),
            **medians("kept"),
        },
    ])
