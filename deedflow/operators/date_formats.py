"""Formats of text dates, found from all values of a column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from deedflow.functions.scalars import ISO_DATE_PATTERN, ref
from deedflow.operators.checks import ContractError
from deedflow.operators.reports import count_if, report_rows

TIME = r"( \d{1,2}:\d{2}(:\d{2})?)?$"
# Formats that are tried, each with the shape of its texts: only texts of that shape are parsed.
CANDIDATES = {
    f"{order}[ H:mm[:ss]]": f"^{shape}{TIME}"
    for order, shape in (
        ("M/d/yyyy", r"\d{1,2}/\d{1,2}/\d{4}"), ("d/M/yyyy", r"\d{1,2}/\d{1,2}/\d{4}"),
        ("yyyy/M/d", r"\d{4}/\d{1,2}/\d{1,2}"),
        ("M-d-yyyy", r"\d{1,2}-\d{1,2}-\d{4}"), ("d-M-yyyy", r"\d{1,2}-\d{1,2}-\d{4}"),
        ("d.M.yyyy", r"\d{1,2}\.\d{1,2}\.\d{4}"),
        ("yyyyMMdd", r"\d{8}"),
        ("d-MMM-yyyy", r"\d{1,2}-[A-Za-z]{3}-\d{4}"), ("MMM d, yyyy", r"[A-Za-z]{3} \d{1,2}, \d{4}"),
    )
}


def _parsed(name: str, fmt: str, shape: str) -> Column:
    """The value under a format; NULL for ISO text, which needs none."""
    text = ref(name)
    return F.when(text.rlike(shape) & ~text.rlike(ISO_DATE_PATTERN), F.try_to_timestamp(text, F.lit(fmt)))


def format_votes(df: DataFrame, names: Iterable[str], candidates: Mapping[str, str] = CANDIDATES) -> DataFrame:
    """Values of each column that each format reads: `column`, `format`, `values`. One aggregation."""
    return report_rows(df, [
        {"column": name, "format": fmt, "values": count_if(_parsed(name, fmt, shape).isNotNull())}
        for name in names for fmt, shape in candidates.items()
    ], "column string, format string, values long")


def infer_formats(
    df: DataFrame, names: Iterable[str], candidates: Mapping[str, str] = CANDIDATES
) -> dict[str, tuple[str, ...]]:
    """The format of each text column of `names` that is not wholly ISO.

    The format that reads most values wins; values that it does not read stay NULL, as with a format
    given by hand. Where two formats read equally many and disagree on any of them, nothing
    tells which is meant: an error asks for the format. Columns of other types, ISO columns and those that no format
    reads have no entry. One aggregation over the text columns, and another if formats tie.
    """
    texts = [name for name in dict.fromkeys(names) if name in df.columns and isinstance(df.schema[name].dataType, T.StringType)]
    if not texts:
        return {}
    best: dict[str, list[str]] = {}
    most: dict[str, int] = {}
    # One row per column and format.
    for column, fmt, values in format_votes(df, texts, candidates).collect():
        if values > most.get(column, 0):
            best[column], most[column] = [fmt], values
        elif values and values == most[column]:
            best[column].append(fmt)
    ties = [(name, *pair) for name, formats in best.items() for pair in combinations(formats, 2)]
    differing = report_rows(df, [
        {"column": name, "first": a, "second": b, "differing": count_if(
            _parsed(name, a, candidates[a]) != _parsed(name, b, candidates[b]))}
        for name, a, b in ties
    ]).filter("differing > 0").collect() if ties else []
    if differing:
        raise ContractError("give the formats of ambiguous dates: " + ", ".join(
            f"{row['column']} ({row['first']} or {row['second']})" for row in differing))
    return {name: (formats[0],) for name, formats in best.items()}


def formats_of(
    df: DataFrame, names: Iterable[str], formats: Sequence[str] | Mapping[str, Sequence[str]] | None
) -> Sequence[str] | Mapping[str, Sequence[str]]:
    """The given formats, or those inferred from the columns where none are given; an empty list means ISO only."""
    return infer_formats(df, names) if formats is None else formats
