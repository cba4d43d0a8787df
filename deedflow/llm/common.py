"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows that one task ranks or walks over as one group, on average.
GROUP_ROWS = 512
# Buckets whose sums one task adds up.
FAN = 4096
# One hot key is joined in so many parts.
SALTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a local session without one makes its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def masked(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table under column names that clash with nothing, and the new name of each column."""
    names = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    return docs.select(*[F.col("`" + old.replace("`", "``") + "`").alias(new) for old, new in names.items()]), names


def unmasked(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(new).alias(old) for old, new in names.items()])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words between white space; NULL has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE_RUN))).cast("long")


def unit(hashed: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def text_key(name: str) -> list[Column]:
    """A text column as two columns that are never NULL, in its own order with NULL last."""
    return [F.col(name).isNull().cast("int").alias("_none"), F.coalesce(F.col(name), F.lit("")).alias("_name")]


def repeated(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row `times` times, numbered from 0, in bounded pieces."""
    piece = 1 << 14
    return (
        df.withColumn("_piece", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {piece})")))
        .withColumn(index, F.explode(F.expr(
            f"sequence(_piece * {piece}, least({times}, (_piece + 1) * {piece}) - 1)")))
        .drop("_piece")
    )


def ranked(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], weight: str) -> DataFrame:
    """Weight of all rows before a row (`_before`) and of its whole group (`_all`).

    Rows are ordered by `bucket`, then by `order`. Only the rows of one bucket
    meet in a task; buckets are summed up in two levels, so that no window
    grows with a group.
    """
    sums = df.groupBy(*keys, bucket).agg(F.sum(weight).alias("_sum"))
    sums = sums.withColumn("_upper", F.expr(f"{bucket} div {FAN}"))
    uppers = sums.groupBy(*keys, "_upper").agg(F.sum("_sum").alias("_upper_sum"))
    by_upper = Window.partitionBy(*keys).orderBy("_upper").rowsBetween(Window.unboundedPreceding, -1)
    uppers = uppers.select(
        *keys, "_upper",
        F.coalesce(F.sum("_upper_sum").over(by_upper), F.lit(0)).alias("_upper_before"),
        F.sum("_upper_sum").over(Window.partitionBy(*keys)).alias("_all"),
    )
    by_bucket = Window.partitionBy(*keys, "_upper").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *keys, bucket, "_upper", F.coalesce(F.sum("_sum").over(by_bucket), F.lit(0)).alias("_sum_before")
    ).join(uppers, [*keys, "_upper"])
    sums = sums.select(*keys, bucket, (F.col("_sum_before") + F.col("_upper_before")).alias("_offset"), "_all")
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(sums, [*keys, bucket])
        .withColumn("_before", F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_offset")
    )
