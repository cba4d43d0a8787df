"""Records of CSV files with line breaks in quoted fields, read in splits.

Whether a line begins inside a quoted field depends on all lines before it. A line, and so a
split of a file, is a function from the state it begins in to the state it
ends in: it keeps the state, turns it, or sets it. Lines are composed inside their split and
splits along their file, so each task sees one split only and the
rest is a window over one row per split.

The text of such files is shuffled once, by split. Only records that span lines are put together from
several; a record is as long as it is in any reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

# A quoted field from its start on, and the rest of one that was open.
QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
CLOSING = r'^[^"]*+(?:""[^"]*+)*+"'
OPENING = r'(^|,)"'

SPLIT = ("path", "block")


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line ends inside a quoted field, if it begins inside of one or not.

    A quote opens a field only where the field begins; elsewhere it stands for itself.
    """
    if inside:
        rest = F.concat(F.lit("q"), F.regexp_replace(line, CLOSING, ""))
        return F.when(line.rlike(CLOSING), ends_inside(rest, False)).otherwise(True)
    return F.regexp_replace(line, QUOTED, "$1q").rlike(OPENING)


def file_lines(spark: SparkSession, paths: Sequence[str], path: Column) -> DataFrame:
    """Lines as `path`, `block` (where their split begins), `line` (their order in it) and `value`."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )


def _composed(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Adds `before0` and `before1`: the state before a row if its group begins outside or inside.

    Rows carry `out` and `ins`, the states they end in (0 or 1) from either state.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = Window.partitionBy(*keys).orderBy(order)
    turned = df.withColumn("_turns", F.sum(F.expr("if(out = 1 AND ins = 0, 1, 0)")).over(so_far) % 2)
    # What a row sets, as if nothing had turned before it.
    known = turned.withColumn("_set", F.last(F.expr("if(out = ins, out ^ _turns, NULL)"), ignorenulls=True).over(so_far))
    for state in (0, 1):
        after = F.coalesce("_set", F.lit(state)).bitwiseXOR(F.col("_turns"))
        known = known.withColumn(f"before{state}", F.lag(after, 1, state).over(rows))
    return known.drop("_turns", "_set")


def _stated(lines: DataFrame) -> DataFrame:
    quoted = F.contains("value", F.lit('"'))
    states = {
        name: F.when(quoted, ends_inside(F.col("value"), inside).cast("int")).otherwise(int(inside)).cast("long")
        for name, inside in (("out", False), ("ins", True))
    }
    return _composed(lines.withColumns(states), SPLIT, "line")


def split_states(lines: DataFrame) -> DataFrame:
    """One row per split: `path`, `block`, `inside` (how it begins), `origin` and `last` of the record that is
    open then, `header` (record of the first line that is not empty, in the first split), `crlf` (whether the
    first line of the file ends so) and `ends` (how it ends).
    """
    stated = _stated(lines)
    running = Window.partitionBy(*SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    stated = stated.withColumn("_n", F.sum(F.expr("if(before0 = 0, 1L, 0L)")).over(running))
    splits = stated.groupBy(*SPLIT).agg(
        F.expr("max_by(if(before0 = 1, ins, out), line) AS out"), F.expr("max_by(if(before1 = 1, ins, out), line) AS ins"),
        F.expr("sum(if(before0 = 0, 1L, 0L)) AS starts0"), F.expr("sum(if(before1 = 0, 1L, 0L)) AS starts1"),
        F.expr("min(if(before0 = 0 AND rtrim('\r', value) <> '', _n, NULL)) AS header"),
        F.expr("min_by(endswith(value, '\r'), line) AS crlf"),
    )
    # One row per split, in order of the file.
    splits = _composed(splits, ["path"], "block").selectExpr(
        "path", "block", "before0 AS inside", "if(before0 = 1, ins, out) AS ends",
        "if(before0 = 1, starts1, starts0) AS starts", "header",
        "first(crlf) OVER (PARTITION BY path ORDER BY block) AS crlf")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.expr("if(starts > 0, struct(block AS origin, starts AS last), NULL)"), ignorenulls=True).over(before)
    return splits.withColumn("_open", opened).selectExpr(
        "path", "block", "inside", "ends", "_open.origin AS origin", "_open.last AS last", "header", "crlf")


def unclosed_files(splits: DataFrame) -> set[str]:
    """Files that end inside a quoted field. One row per file is collected."""
    ends = splits.groupBy("path").agg(F.max_by("ends", "block").alias("ends"))
    return {row["path"] for row in ends.filter("ends = 1").collect()}


def records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Records after the header as `path` and `record`, in no particular order; empty lines are left out.

    Where the first line ends with a carriage return, those at other line ends are dropped too.
    """
    stated = _stated(lines).join(splits.drop("ends"), list(SPLIT))
    running = Window.partitionBy(*SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    stated = stated.withColumn("_before", F.expr("if(inside = 1, before1, before0)")).withColumn(
        "_n", F.sum(F.expr("if(_before = 0, 1L, 0L)")).over(running)
    ).selectExpr(
        "path", "block", "line", "if(crlf, regexp_replace(value, '\r$', ''), value) AS value", "_before", "if(_before = 1, ins, out) AS _after",
        "if(_n = 0, origin, block) AS origin", "if(_n = 0, last, _n) AS n", "header",
    )
    # The header lies in the first split.
    body = stated.filter("NOT (block = 0 AND n <=> header)")
    alone = body.filter("_before = 0 AND _after = 0").select("path", F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = body.filter("_before = 1 OR _after = 1").groupBy("path", "origin", "n").agg(
        F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("record"))
    every = alone.unionByName(joined.select("path", "record"))
    return every.filter("record <> ''")


def parsed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The fields of `record` as text columns, with the other columns."""
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1"}
    fields = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    others = [name for name in df.columns if name != "record"]
    rows = df.select(*others, fields.alias("_fields"))
    return rows.select(
        *[F.col(f"_fields.c{k}").alias(name) for k, name in enumerate(names)], *others)
