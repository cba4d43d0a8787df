"""Exploration of numeric fields: distributions, shares, top groups, plot data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from deedflow import fields as f
from deedflow.functions.scalars import Formats, ref, rounded, to_double, to_timestamp
from deedflow.operators.distribution import (
    CELL, FIELD, MISSING_CELL, VALUE, WEIGHT, cell_counts, count_values, distribution,
)
from deedflow.operators.outliers import QUARTILES, fence_report, with_fences
from deedflow.operators.reports import count_if, report_rows, row_count

PERCENTILES = {
    "p01": 0.01, "p05": 0.05, "p25": 0.25, "median_p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99,
}


def numeric_summary(df: DataFrame, fields: Sequence[str], described: DataFrame | None = None) -> DataFrame:
    """Counts, percentiles, mean and sample deviation, one row per field.

    `described`, the distribution with `PERCENTILES`, saves computing it.
    """
    if described is None:
        described = distribution(df, fields, PERCENTILES)
    measures = (
        "min", "p01", "p05", "p25", "mean", "median_p50", "p75", "p95", "p99", "max",
    )
    return described.select(
        "field",
        "non_missing_count",
        "missing_count",
        *[rounded(name, 2).alias(name) for name in measures],
        rounded("std", 2).alias("standard_deviation"),
    )


def field_center(df: DataFrame, field: str) -> DataFrame:
    """Mean, median and 95th percentile."""
    return distribution(df, [field], {"median": 0.5, "p95": 0.95}).select(
        "field", "mean", "median", "p95"
    )


def share_vs_reference(df: DataFrame, value: str, reference: str) -> DataFrame:
    """Percent of rows above, at and below a positive reference value."""
    a, b = to_double(df, value), to_double(df, reference)
    pairs = df.select(a.alias("a"), b.alias("b")).filter(
        F.col("a").isNotNull() & (F.col("b") > 0)
    )

    def share(condition):
        return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))) * 100

    return pairs.agg(
        row_count().alias("compared_rows"),
        share(F.col("a") > F.col("b")).alias("above_percent"),
        share(F.col("a") == F.col("b")).alias("at_percent"),
        share(F.col("a") < F.col("b")).alias("below_percent"),
    )


def rows_before(df: DataFrame, earlier: str, later: str, formats: Formats = ()) -> DataFrame:
    """Number of rows whose first date lies before the second."""
    before = to_timestamp(df, earlier, formats) < to_timestamp(df, later, formats)
    return df.agg(count_if(before).alias("rows"))


def county_field(df: DataFrame) -> str | None:
    return next((name for name in ("CountyOrParish", "County") if name in df.columns), None)


def top_groups(
    df: DataFrame, group: str, value: str, min_count: int = 10, n: int = 10, counted: DataFrame | None = None
) -> DataFrame:
    """Groups with the highest medians among those with enough values.

    `counted` (`values_of_groups`) saves reading the table.
    """
    return (
        distribution(df.filter(ref(group).isNotNull()), [value], by=[group], counted=counted)
        .filter(F.col("non_missing_count") >= min_count)
        .select(ref(group), F.col("non_missing_count").alias("transaction_count"), "median")
        .orderBy(F.desc("median"), ref(group))
        .limit(n)
    )


def histogram(df: DataFrame, field: str, bins: int = 50) -> DataFrame:
    """Equal-width bins of one field; see `histograms`."""
    return histograms(df, [field], bins).drop("field")


def _bin(value: str, bins: int) -> str:
    """Bin of a value between `_start` and `_stop`, from 1."""
    edge = f"_start + {{}} * ((_stop - _start) / {bins})"
    guess = f"least(floor(({value} - _start) / (_stop - _start) * {bins}), {bins - 1})"
    # Rounding may place a value on the wrong side of a computed edge.
    below = f"if({value} < {edge.format(guess)}, 1, 0)"
    above = f"if({guess} < {bins - 1} AND {value} >= {edge.format(f'({guess} + 1)')}, 1, 0)"
    return f"CAST({guess} - {below} + {above} + 1 AS int)"


def _filled(cells: DataFrame) -> DataFrame:
    """Cells of present values. All uses ask for the same columns, so that they share one aggregation."""
    return cells.filter(f"{CELL} <> {MISSING_CELL} AND _n > 0")


def _extents(cells: DataFrame) -> DataFrame:
    """Range of the bins of each field with values, one row per field."""
    pad = "if(min(_low) = max(_high), 0.5D, 0D)"
    return _filled(cells).groupBy(FIELD).agg(
        F.expr(f"min(_low) - {pad} AS _start"), F.expr(f"max(_high) + {pad} AS _stop")
    ).withColumnRenamed(FIELD, "_binned")


def _binned_cells(cells: DataFrame, bins: int) -> DataFrame:
    """Cells with the bins of their least and largest values."""
    # A row per field is broadcast.
    return _filled(cells).join(
        F.broadcast(_extents(cells)), F.expr(f"{FIELD} = _binned")
    ).selectExpr("*", f"{_bin('_low', bins)} AS _first", f"{_bin('_high', bins)} AS _last")


def border_cells(cells: DataFrame, bins: int = 50) -> DataFrame:
    """Keys of the cells that reach over an edge of a bin: fewer than `bins` per field."""
    return _binned_cells(cells, bins).filter("_first < _last").select(FIELD, CELL)


def histograms(
    df: DataFrame, fields: Sequence[str], bins: int = 50, cells: DataFrame | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equal-width bins of several fields from minimum to maximum, empty ones included.

    Bins are closed on the left and the last one on both sides. A column with
    one value gets a range of one around it; one without values gives no rows.

    Bins are filled from cell counts, and only the cells at their edges are opened: two scans
    for all fields. `cells` (`cell_counts`) save the first, `counted` (`count_values` of at
    least the `border_cells`) the second.
    """
    if cells is None:
        cells = cell_counts(df, fields)
    if counted is None:
        counted = count_values(df, fields, border_cells(cells, bins))
    placed = _binned_cells(cells, bins)
    # Border cells are bounded by fields and bins.
    border = placed.filter("_first < _last").selectExpr(f"{FIELD} AS _w0", f"{CELL} AS _w1", "_start", "_stop")
    inside = counted.join(F.broadcast(border), F.expr(f"{FIELD} = _w0 AND {CELL} = _w1")).selectExpr(
        FIELD, f"{_bin(VALUE, bins)} AS bin", f"{WEIGHT} AS _n")
    counts = placed.filter("_first = _last").selectExpr(FIELD, "_first AS bin", "_n").unionByName(inside).groupBy(
        F.col(FIELD).alias("_counted"), F.col("bin").alias("_bin")
    ).agg(F.expr("sum(_n) AS _n"))
    every = _extents(cells).selectExpr("*", f"explode(sequence(1, {bins})) AS bin")
    names = F.array(*[F.lit(name) for name in fields])
    width = f"((_stop - _start) / {bins})"
    return every.join(F.broadcast(counts), F.expr("_binned = _counted AND bin = _bin"), "left").select(
        F.element_at(names, F.col("_binned") + 1).alias("field"),
        "bin",
        F.expr(f"_start + (bin - 1) * {width} AS lower"),
        F.expr(f"if(bin = {bins}, _stop, _start + bin * {width}) AS upper"),
        F.expr("coalesce(_n, 0) AS count"),
    )


def boxplot(
    df: DataFrame, fields: Sequence[str], factor: float = f.IQR_FACTOR, bounds: DataFrame | None = None,
    fences: DataFrame | None = None,
) -> DataFrame:
    """Quartiles, whisker ends and outlier counts, one row per field.

    `bounds` (`outliers.iqr_bounds`) and `fences` (`outliers.fence_report`) save computing them.
    """
    if bounds is None:
        bounds = with_fences(distribution(df, fields, QUARTILES), factor)
    if fences is None:
        fences = fence_report(df, bounds, fields)
    # Both sides have one row per field.
    return bounds.join(F.broadcast(fences), "field").select(
        "field", "q1", "median", "q3",
        F.least("least_within", "q1").alias("whisker_low"),
        F.greatest("largest_within", "q3").alias("whisker_high"),
        F.col("below_lower_bound").alias("outliers_below"),
        F.col("above_upper_bound").alias("outliers_above"),
    )
