"""Writing tables and reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

DATE_FORMAT = "yyyy-MM-dd"


def write_dataset(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite a table. CSV has a header and ISO dates.

    Partitioned output is rebalanced first: each value goes to few files and a
    value with very many rows is split over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("dateFormat", DATE_FORMAT).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(report: DataFrame, path: str) -> None:
    """Overwrite a report as CSV. Small ones are one partition already."""
    write_dataset(report, path, "csv")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version of a table as Parquet, make it the current one, and return its folder.

    The data go to a folder of their own. Only when they are complete is a line with its name added to the
    manifest, a file that appears at once or not at all. So a run that dies leaves the version before
    current, and readers of an earlier version keep their files: versions are never overwritten or removed here.
    """
    spark = df.sparkSession
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"
    write_dataset(df, f"{path}/data/{version}", partition_by=partition_by)
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("append").text(f"{path}/manifest")
    return f"{path}/data/{version}"


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the latest published version of a table."""
    # One line per version.
    latest = spark.read.text(f"{path}/manifest").agg(F.max("value").alias("version")).first()["version"]
    if latest is None:
        raise ValueError(f"{path} has no published version")
    return f"{path}/data/{latest}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The latest published version. A later version does not change what was read here."""
    return spark.read.parquet(current_version(spark, path))


def stage(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Publish a table and read it back: lineage ends at files that outlive executors and later runs."""
    reader = df.sparkSession.read
    path = publish(df, f"{folder}/{name}", partition_by)
    # The schema is known: no job reads it from the files. Columns that partition a table come back last.
    return reader.parquet(path) if partition_by else reader.schema(df.schema).parquet(path)


def stage_observed(
    df: DataFrame, folder: str, name: str, measures: Mapping[str, Column], partition_by: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, object]]:
    """`stage`, and aggregates of the rows that were written, gathered by the write itself."""
    seen = Observation(f"write of {name}")
    observed = df.observe(seen, *[column.alias(key) for key, column in measures.items()])
    return stage(observed, folder, name, partition_by), seen.get
