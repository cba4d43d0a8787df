"""The steps from monthly files to market measures, as callable pipelines.

Each step checks its contracts and returns its tables and reports by name.
Ingested text files and finished events are staged as Parquet. The steps between
are projections of the staged table, cheaper to repeat than to store: they stay
lazy unless a folder is given. Most reports stay lazy too; `write_reports` saves them.

`formats` are those of dates in text. Where none are given, a step infers them from all values of
the columns that it reads and stops at ambiguous ones; an empty list means ISO dates only.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from deedflow import fields as f
from deedflow.functions.scalars import Formats, ref, to_double
from deedflow.operators import checks, date_formats, distribution, events, explore, features, outliers, quality, rates
from deedflow.operators.reports import fixed, measures, row_count
from deedflow.sources import files, sinks, staging

Tables = dict[str, DataFrame]
ROWS_UNCHANGED = "row_count_unchanged"


def _rows(df: DataFrame):
    return df.agg(row_count().alias("n")).scalar()


def _kept(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    return df if folder is None else sinks.stage(df, folder, name)


def _verified(
    source: DataFrame, build: Callable[[DataFrame], DataFrame], folder: str | None, name: str,
    checked: Callable[[Column | int], Mapping[str, Column]],
) -> tuple[DataFrame, DataFrame]:
    """The table that a step builds of `source`, and its enforced checks, of which one compares their rows.

    The write of a staged table observes the rows read, the rows written and all checks, so that nothing is
    scanned for them. A lazy table is checked by one aggregation.
    """
    if folder is None:
        table, observed = build(source), {}
    else:
        read = Observation(f"source of {name}")
        table, observed = sinks.stage_observed(
            build(source.observe(read, row_count().alias("rows"))), folder, name, checked(0))
        observed |= {ROWS_UNCHANGED: abs(observed.get(ROWS_UNCHANGED, 0) - read.get.get("rows", -1))}
    return table, _enforced(table, observed, lambda: checked(_rows(source)))


def _enforced(
    table: DataFrame, observed: Mapping[str, int], checked: Callable[[], Mapping[str, Column]]
) -> DataFrame:
    """Checks from observed numbers if all of them hold, else from the table itself.

    A task that ran twice may have been observed twice, so a violation is only believed after a scan.
    """
    if observed and not any(observed.values()):
        return checks.check_counts(table.sparkSession, observed)
    report = checks.check(table, checked())
    checks.enforce(report)
    return report


def write_reports(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        sinks.write_report(table, f"{folder}/{name}")


def ingest(
    spark: SparkSession,
    pattern: str,
    dataset: str,
    folder: str | None = None,
    prefer_suffix: str | None = None,
    keep: tuple[str, str] = ("PropertyType", "Residential"),
    multi_line: bool | None = None,
) -> Tables:
    """Union the files that match, keep one property type, stage the result."""
    folder = staging.work_folder(spark, folder)
    found = files.list_files(spark, pattern)
    if prefer_suffix:
        found = files.prefer_versions(found, prefer_suffix)
    paths = files.file_paths(found)
    headers = files.read_headers(spark, paths)
    combined = files.read_union(spark, paths, multi_line, headers)
    column, value = keep
    checks.require_columns(combined, [column], dataset)
    # Text files are parsed once; counts and later steps read the staged copy.
    staged, seen = sinks.stage_observed(combined, folder, f"{dataset}_combined", {"rows": row_count()})
    condition = F.col(column) == value
    report = files.file_report(staged, headers)
    if not files.unions_reconcile(report, seen.get("rows", 0)):
        warnings.warn(f"{dataset}: rows of the files and of the staged union differ", stacklevel=2)
    return {
        "table": staged.filter(condition),
        "files": report,
        "filter": quality.filter_counts(staged, condition, dataset),
    }


def audit_and_prune(df: DataFrame, dataset: str, threshold: float = 90) -> Tables:
    """Missingness report, and the table without its sparse columns."""
    # One row per column; collected once for the drop and kept as the report.
    report = fixed(quality.missingness(df))
    dropped = quality.sparse_columns(report, threshold)
    tables = {
        "table": quality.drop_columns(df, dropped),
        "missingness": report,
        "most_missing": quality.most_missing(report),
        "dropped": quality.dropped_report(df.sparkSession, {dataset: dropped}, threshold),
    }
    if "PropertyType" in df.columns:
        tables["property_types"] = quality.category_counts(df, "PropertyType")
    return tables


def explore_sold(
    sold: DataFrame, fields: Sequence[str] = f.EXPLORED_FIELDS, formats: Formats | None = None,
    folder: str | None = None, dataset: str = "sold",
) -> Tables:
    """Distributions, outlier bounds, plot data and the usual questions.

    Three scans serve all distributions: one counts the cells of all fields, one opens the cells that any
    report wants and counts the prices by county, and one compares values with the outlier bounds. The
    first two are staged. The remaining questions read the one or two columns that they name.
    """
    available, _ = checks.split_fields(sold, fields)
    formats = date_formats.formats_of(sold, ("CloseDate", "ListingContractDate"), formats)
    folder = staging.work_folder(sold.sparkSession, folder)
    present = set(sold.columns)
    county = explore.county_field(sold)
    by_county = county and "ClosePrice" in present
    cells = sinks.stage(distribution.cell_counts(sold, available), folder, f"{dataset}_cells")
    wanted = distribution.wanted_cells(cells, explore.PERCENTILES).unionByName(explore.border_cells(cells))
    groups = {"group": ref(county), "grouped": to_double(sold, "ClosePrice")} if by_county else {}
    counted = sinks.stage(
        distribution.count_values(sold, available, wanted, **groups), folder, f"{dataset}_values")
    opened = distribution.values_of_cells(counted)
    # One row per field.
    described = fixed(distribution.distribution(
        sold, available, explore.PERCENTILES, cells=cells, counted=opened))
    bounds = outliers.with_fences(described.withColumns({
        "q1": F.col("p25"), "median": F.col("median_p50"), "q3": F.col("p75")}))
    fences = fixed(outliers.fence_report(sold, bounds.collect(), available))
    tables = {
        "numeric_summary": explore.numeric_summary(sold, available, described),
        "iqr_summary": outliers.iqr_summary(sold, available, bounds=bounds, fences=fences),
        "boxplots": explore.boxplot(sold, available, bounds=bounds, fences=fences),
    }
    histograms = explore.histograms(sold, available, cells=cells, counted=opened)
    for name in available:
        tables[f"histogram_{name}"] = histograms.filter(F.col("field") == name).drop("field")
    if "PropertyType" in present:
        tables["property_types"] = quality.category_counts(sold, "PropertyType")
    for name in ("ClosePrice", "DaysOnMarket"):
        if name in available:
            tables[f"center_{name}"] = described.filter(F.col("field") == name).select(
                "field", "mean", F.col("median_p50").alias("median"), "p95")
        elif name in present:
            tables[f"center_{name}"] = explore.field_center(sold, name)
    if {"ClosePrice", "ListPrice"} <= present:
        tables["price_vs_list"] = explore.share_vs_reference(sold, "ClosePrice", "ListPrice")
    if {"ListingContractDate", "CloseDate"} <= present:
        tables["close_before_listing"] = explore.rows_before(
            sold, "CloseDate", "ListingContractDate", formats)
    if by_county:
        tables["top_counties"] = explore.top_groups(
            sold, county, "ClosePrice", counted=distribution.values_of_groups(counted, county))
    return tables


def enrich(
    df: DataFrame, monthly: DataFrame, date: str, dataset: str, folder: str | None = None,
    formats: Formats | None = None,
) -> Tables:
    """Join the monthly rate; every row must keep its place and find a rate."""
    rates.require_rates(monthly)
    formats = date_formats.formats_of(df, [date], formats)
    staged, report = _verified(
        df, lambda rows: rates.enrich_monthly(rows, monthly, date, formats), folder, f"{dataset}_enriched",
        checks.rate_checks)
    return {
        "table": staged,
        "quality": rates.join_quality(df, staged, date, dataset),
        "unmatched_months": rates.unmatched_months(staged, dataset),
        "checks": report,
    }


def clean(
    df: DataFrame, dataset: str, folder: str | None = None, formats: Formats | None = None
) -> Tables:
    """Types, validity flags and date and coordinate flags; every row is kept.

    All reports come from the write of the staged table, which observes them; without a folder,
    from one scan of the source and one of the result.
    """
    checks.require_flags(df, f.FILLED_INDICATORS)
    source = quality.with_redundancy(df)
    formats = date_formats.formats_of(source, f.DATE_FIELDS, formats)
    built = quality.clean(df, formats)
    before = {
        "redundant": quality.redundant_entries(df, dataset),
        "types": quality.coercion_entries(source, dataset, formats=formats),
    }
    after = {
        "numeric": quality.invalid_entries(built, dataset),
        "dates": quality.flag_entries(built, f.TIMELINE_FLAGS, dataset),
        "geographic": quality.flag_entries(built, (*f.GEO_FLAGS, f.FILLED_FLAG), dataset),
    }
    read = {"rows_before": row_count(), **measures(before)}
    written = {"rows_after": row_count(), **measures(after)}
    table, seen = built, {}
    if folder is not None:
        observed = Observation(f"source of {dataset}_clean")
        kept = source.observe(observed, *[column.alias(key) for key, column in read.items()]).select(
            *[ref(name) for name in quality.coalesce_redundant(df).columns])
        table, seen = sinks.stage_observed(quality.clean(kept, formats), folder, f"{dataset}_clean", written)
        seen |= observed.get
        rows = table.count()
        # Rows as stored, from the files' footers: a task that ran twice would have been observed twice.
        if not rows == seen.get("rows_before") == seen.get("rows_after"):
            seen = {}
    if not seen:
        for one, asked in ((source, read), (table, written)):
            seen |= one.agg(*[column.alias(key) for key, column in asked.items()]).first().asDict()
    report = checks.check_counts(df.sparkSession, {ROWS_UNCHANGED: abs(seen["rows_after"] - seen["rows_before"])})
    checks.enforce(report)
    reports = {name: one.table(df.sparkSession, seen.get(name, ())) for name, one in (before | after).items()}
    return {
        "table": table,
        "checks": report,
        "dataset": quality.dataset_summary(df, table, dataset, (seen["rows_before"], seen["rows_after"])),
        **reports,
    }


def engineer(
    sold: DataFrame, folder: str | None = None, method: str = "exact", dataset: str = "sold",
    formats: Formats | None = None,
) -> Tables:
    """Ratios and durations, a sample, a metric summary and segment summaries."""
    formats = date_formats.formats_of(sold, features.DATES, formats)
    staged, report = _verified(
        sold, lambda rows: features.engineer(rows, formats), folder, f"{dataset}_engineered", checks.feature_checks)
    sample = features.sample_rows(staged)
    features.require_sample(sample)
    return {
        "table": staged,
        "checks": report,
        "sample": sample,
        "features": features.feature_summary(staged),
        "segments": features.segment_summaries(staged, method=method),
    }


def remove_outliers(
    engineered: DataFrame, folder: str | None = None, expected_rows: int | None = None,
    dataset: str = "sold",
) -> Tables:
    """Flag outliers and broken rules; the filtered table is a view of the flagged one."""
    checks.require_columns(engineered, f.OUTLIER_FLAGS)
    checks.require_flags(engineered, [rule.flag for rule in f.BUSINESS_RULES])
    fields = list(f.OUTLIER_FLAGS)
    # One row per field: the bounds are computed once, for the report and for the flags.
    bounds = fixed(outliers.iqr_bounds(engineered, fields, quantiles=outliers.QUARTILES | outliers.TAILS))
    thresholds = outliers.iqr_thresholds(engineered, fields, bounds=bounds)
    outliers.require_usable(thresholds)
    flagged = _kept(
        outliers.exclusion_flags(outliers.iqr_flags(engineered, bounds=bounds.collect())), folder, f"{dataset}_flagged"
    )
    checks.require_columns(flagged, engineered.columns, "flagged table")
    checks.require_boolean(
        flagged, [*f.OUTLIER_FLAGS.values(), f.ANY_OUTLIER_FLAG, f.BUSINESS_RULE_FLAG, f.EXCLUSION_FLAG]
    )
    rows = _rows(engineered) if expected_rows is None else expected_rows
    report = checks.check(flagged, checks.outlier_checks(rows))
    checks.enforce(report)
    return {
        "flagged": flagged,
        "table": outliers.kept_rows(flagged),
        "checks": report,
        "thresholds": thresholds,
        "comparison": outliers.before_after(flagged, bounds=bounds),
    }


def build_events(
    listings: DataFrame, sold: DataFrame, folder: str | None = None, start: str = f.EVENT_FLOOR,
    formats: Formats | None = None, name: str = "market_events", ordered: bool = False,
) -> Tables:
    """The market-event table by month, its reports and the monthly measures.

    `ordered` writes the table in its final order (see `sorted_events`), not by month.
    """
    folder = staging.work_folder(sold.sparkSession, folder)
    listed = events.listing_events(
        listings, start, date_formats.formats_of(listings, ["ListingContractDate"], formats))
    sales = events.sale_events(sold, start, date_formats.formats_of(sold, ["CloseDate"], formats))
    kinds = [Observation(f"{name} of listings"), Observation(f"{name} of sales")]
    # The events of each kind are counted before they are put together, and all of them as they are written.
    combined = listed.observe(kinds[0], row_count().alias("rows")).unionByName(
        events.clean_ratio(sales.observe(kinds[1], row_count().alias("rows"))))
    if ordered:
        combined, partition_by = events.sorted_events(combined), []
    else:
        partition_by = ["EventMonth"]
    staged, observed = sinks.stage_observed(combined, folder, name, checks.event_checks(0, start), partition_by)
    staged = staged.select(*f.EVENT_SCHEMA.names)
    read = sum(kind.get.get("rows", 0) for kind in kinds)
    observed |= {"row_count_reconciles": abs(observed.get("row_count_reconciles", 0) - read)}
    report = _enforced(
        staged, observed, lambda: checks.event_checks(_rows(listed) + _rows(sales), start))
    return {
        "table": staged,
        "checks": report,
        "preparation": events.preparation_summary(listings, sold, staged),
        "coverage": events.field_coverage(staged),
        "ratio_cleaning": events.ratio_cleaning(sales),
        "monthly": events.monthly_market(staged),
    }
