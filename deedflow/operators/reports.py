"""Reports of several rows from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def report_rows(
    df: DataFrame, rows: Sequence[Mapping[str, object]], schema: str | None = None
) -> DataFrame:
    """One output row per entry, all computed by a single aggregation.

    Entries map output columns to aggregates or constants and share their keys.
    Where there may be no entries, `schema` describes the empty report.
    """
    if not rows and schema:
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(_entries(rows).alias("rows")).select(F.inline("rows"))


def _entries(rows: Sequence[Mapping[str, object]]) -> Column:
    return F.array(*[
        F.struct(*[_column(value).alias(name) for name, value in row.items()]) for row in rows
    ])


@dataclass(frozen=True)
class Report:
    """Entries of a report and its schema, to be computed with others by one aggregation."""

    rows: Sequence[Mapping[str, object]]
    schema: str

    def of(self, df: DataFrame) -> DataFrame:
        return report_rows(df, self.rows, self.schema)

    def table(self, spark: SparkSession, measured: Sequence[Row]) -> DataFrame:
        """The report from its measured rows."""
        return spark.createDataFrame([tuple(row) for row in measured], self.schema)


def measures(reports: Mapping[str, Report]) -> dict[str, Column]:
    """One aggregate per report that has entries, for an aggregation or an observation."""
    return {name: _entries(report.rows) for name, report in reports.items() if report.rows}


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; 0 for an empty table."""
    return F.coalesce(F.count_if(condition), F.lit(0))


def row_count() -> Column:
    return F.count(F.lit(1))


def fixed(report: DataFrame) -> DataFrame:
    """A report with a row per field or column, computed now and kept as rows of the plan."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
