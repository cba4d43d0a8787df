"""Reading monthly CSV extracts whose columns drift, and staged tables."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from deedflow.functions.scalars import Formats, na_to_null, ref
from deedflow.operators.checks import ContractError, require_columns
from deedflow.operators.date_formats import formats_of
from deedflow.operators.quality import union_by_name, union_report
from deedflow.operators.rates import select_rates
from deedflow.sources import records

SOURCE_FILE = "source_file"


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths that match a glob, in order. File contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path").orderBy("path")


def prefer_versions(files: DataFrame, suffix: str = "_filled") -> DataFrame:
    """One path per folder and file stem: the one with the suffix where both exist."""
    folder = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    name = F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1)
    filled = name.endswith(suffix)
    stem = F.when(filled, F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)
    return (
        files.groupBy(folder.alias("folder"), stem.alias("stem"))
        .agg(F.max_by("path", F.struct(filled, F.col("path"))).alias("path"))
        .orderBy("folder", "stem")
    )


def file_paths(files: DataFrame) -> list[str]:
    """The paths as a list, bounded by the number of files."""
    return [row["path"] for row in files.select("path").orderBy("path").collect()]


def _csv(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )


def unique_names(header: Sequence[str | None]) -> list[str]:
    """Header names made unique: the second `A` becomes `A.1`, an empty one `Unnamed: 3`."""
    given = [name or f"Unnamed: {position}" for position, name in enumerate(header)]
    names: list[str] = []
    for name in given:
        candidate, copy = name, 0
        while candidate in names or (copy and candidate in given):
            copy += 1
            candidate = f"{name}.{copy}"
        names.append(candidate)
    return names


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file, from its first record only."""
    first = _csv(spark, True).option("header", False).csv(path).first()
    return tuple(unique_names(list(first or ())))


def _plain_path(path: str) -> str:
    """A path without scheme, as Spark may write it with another number of slashes."""
    return re.sub(r"^file:/+", "/", path)


def read_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Column names per file, from one job over the first line of each.

    Only a file whose first line leaves a quote open is probed by itself.
    """
    lines = spark.read.text(list(paths)).select(
        _decoded(F.col("_metadata.file_path")).alias("path"), "value",
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"),
    )
    # Rows of the first block of a file are numbered in their order.
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "row").alias("value"))
    # One line per file.
    lines = {_plain_path(row["path"]): row["value"] for row in first.collect()}
    headers = {}
    for path in paths:
        line = lines.get(_plain_path(path))
        if line is None or line.count('"') % 2:
            headers[path] = read_header(spark, path)
        else:
            record = next(csv.reader([line.lstrip("\ufeff")]), [])
            headers[path] = tuple(unique_names(record))
    return headers


def file_labels(paths: Iterable[str]) -> dict[str, str]:
    """A name per path: the file name, with as many folders before it as it takes to tell all apart."""
    split = {path: _plain_path(path).split("/") for path in paths}
    for depth in range(1, 1 + max(map(len, split.values()), default=1)):
        labels = {path: "/".join(parts[-depth:]) for path, parts in split.items()}
        if len(set(labels.values())) == len(labels):
            break
    return labels


def _label(depth: int) -> Column:
    """`file_labels` of the file that a row comes from."""
    if depth == 1:
        return _decoded(F.col("_metadata.file_name"))
    return F.regexp_extract(_decoded(F.col("_metadata.file_path")), "((?:[^/]*/){%d}[^/]*)$" % (depth - 1), 1)


def check_letter_case(names: Iterable[str]) -> None:
    """Spark resolves names without regard to case, so they must differ otherwise."""
    spellings = defaultdict(set)
    for name in names:
        spellings[name.lower()].add(name)
    clashes = sorted(sorted(group) for group in spellings.values() if len(group) > 1)
    if clashes:
        raise ContractError(f"column names that differ only in case: {clashes}")


def normalise_missing(df: DataFrame) -> DataFrame:
    """Missing-value tokens of text columns as NULL."""
    return df.select(*[
        na_to_null(ref(field.name)).alias(field.name)
        if isinstance(field.dataType, T.StringType)
        else ref(field.name)
        for field in df.schema
    ])


def _decoded(uri_part: Column) -> Column:
    """File name or path as text; a plus sign stands for itself."""
    return F.url_decode(F.replace(uri_part, F.lit("+"), F.lit("%2B")))


def files_with_line_breaks(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Those of the paths whose files have line breaks in quoted fields.

    A line that opens such a field, or closes one, has an odd number of quotes.
    The lines are read as text, so that large files are split over many tasks.
    """
    odd = F.expr("(length(value) - length(replace(value, '\"', ''))) % 2 = 1")
    found = spark.read.text(list(paths)).filter(odd).select(
        _decoded(F.col("_metadata.file_path")).alias("path")
    )
    known = {_plain_path(row["path"]) for row in found.distinct().collect()}
    return {path for path in paths if _plain_path(path) in known}


def _path() -> Column:
    return _decoded(F.col("_metadata.file_path"))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return records.file_lines(spark, paths, _path())


def unclosed_files(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Those of the paths whose files end inside a quoted field; only a reader of whole files makes sense of them."""
    if not paths:
        return set()
    known = {_plain_path(path) for path in records.unclosed_files(records.split_states(_lines(spark, paths)))}
    return {path for path in paths if _plain_path(path) in known}


def _read_files(
    spark: SparkSession, header: Sequence[str], paths: Sequence[str], how: str, depth: int | None
) -> DataFrame:
    """Files of one header: in splits by `lines`, in splits by `records`, or in one piece each (`whole`).

    With a `depth` the name of the file is added (see `file_labels`).
    """
    if how == "records":
        lines = _lines(spark, paths)
        rows = records.parsed(records.records(lines, records.split_states(lines)), header)
        name = F.regexp_extract("path", "((?:[^/]*/){%d}[^/]*)$" % ((depth or 1) - 1), 1)
        rows = rows.select(*[ref(column) for column in header], name.alias(SOURCE_FILE))
        return normalise_missing(rows if depth else rows.drop(SOURCE_FILE))
    schema = T.StructType([T.StructField(column, T.StringType()) for column in header])
    rows = _csv(spark, how == "whole").option("header", True).schema(schema).csv(list(paths))
    return normalise_missing(rows.withColumn(SOURCE_FILE, _label(depth)) if depth else rows)


def _ways(spark: SparkSession, paths: Sequence[str], multi_line: bool | None) -> dict[str, str]:
    """How each file is read."""
    if multi_line is not None:
        return dict.fromkeys(paths, "whole" if multi_line else "lines")
    broken = files_with_line_breaks(spark, paths)
    whole = unclosed_files(spark, sorted(broken))
    return {path: "whole" if path in whole else "records" if path in broken else "lines" for path in paths}


def read_union(
    spark: SparkSession,
    paths: Sequence[str],
    multi_line: bool | None = None,
    headers: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """All files as text columns, aligned by name, with the file they came from (see `file_labels`).

    Files with equal headers share one scan. By default one pass over the text finds
    files with line breaks in quoted fields, and all files are read in splits: those without breaks by lines,
    the others by records (see `records`). `multi_line` settles for all files whether each is read in one piece.
    `headers` saves probing the files again (see `read_headers`).
    """
    if not paths:
        raise ContractError("no files to read")
    headers = headers or read_headers(spark, paths)
    check_letter_case({name for header in headers.values() for name in header})
    ways = _ways(spark, list(headers), multi_line)
    depth = 1 + next(iter(file_labels(headers).values())).count("/")
    groups: dict[tuple[tuple[str, ...], str], list[str]] = defaultdict(list)
    for path, header in headers.items():
        groups[header, ways[path]].append(path)
    combined = union_by_name([_read_files(spark, header, group, how, depth) for (header, how), group in groups.items()])
    data = [column for column in combined.columns if column != SOURCE_FILE]
    return combined.select(*[ref(column) for column in data], SOURCE_FILE)


def file_report(combined: DataFrame, headers: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Rows and columns per file, and the total row with `is_total` set.

    Files without rows are listed too.
    """
    labels = file_labels(headers)
    widths = [(labels[path], len(header)) for path, header in headers.items()]
    columns = combined.sparkSession.createDataFrame(widths, f"{SOURCE_FILE} string, column_count int")
    counted = union_report(combined, SOURCE_FILE)
    # One row per file on both sides.
    files = columns.join(counted.filter(~F.col("is_total")), SOURCE_FILE, "left").select(
        SOURCE_FILE,
        "column_count",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.lit(False).alias("is_total"),
    )
    total = counted.filter("is_total").select(
        SOURCE_FILE, F.lit(len(combined.columns) - 1).alias("column_count"), "row_count", "is_total"
    )
    return files.unionByName(total)


def unions_reconcile(report: DataFrame, parsed: int | None = None) -> bool:
    """Whether the files' rows add up to the total; a mismatch is only a warning.

    `parsed` is the number of rows read from the files, as observed while they were
    staged. With it, it is set against the report, which is one of the staged copy.
    """
    sums = report.groupBy("is_total").agg(F.sum("row_count").alias("n")).collect()
    totals = {row["is_total"]: row["n"] for row in sums}
    expected = totals.get(False, 0) if parsed is None else parsed
    return totals.get(True, 0) == expected == totals.get(False, 0)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A staged table. CSV columns come as text with missing tokens as NULL; large files are read in splits."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    header = read_header(spark, path)
    check_letter_case(header)
    groups = defaultdict(list)
    for file, how in _ways(spark, file_paths(list_files(spark, path)), None).items():
        groups[how].append(file)
    return union_by_name([_read_files(spark, header, group, how, None) for how, group in groups.items()])


def select_available(
    df: DataFrame, required: Sequence[str], optional: Sequence[str] = (), what: str = "table"
) -> DataFrame:
    """Required columns, an error naming those that lack, and optional ones present."""
    require_columns(df, required, what)
    return df.select(*[ref(name) for name in (*required, *(n for n in optional if n in df.columns))])


def read_rates(
    spark: SparkSession, path: str, date: str = "observation_date", rate: str = "MORTGAGE30US",
    formats: Formats | None = None,
) -> DataFrame:
    """Weekly observations from a staged CSV file. Without `formats`, that of the dates is inferred."""
    raw = read_table(spark, path, "csv")
    return select_rates(raw, date, rate, formats_of(raw, [date], formats))
