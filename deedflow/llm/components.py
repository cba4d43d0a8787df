"""Connected components of a graph of long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import staged


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(CAST(hash(u, v) AS long))")).first())


def components(edges: DataFrame) -> DataFrame:
    """Each node of `edges` (`u`, `v`) as `node` with the smallest node it reaches as `root`.

    Large stars hang every larger neighbour of a node on its least neighbour, small
    stars every smaller one; both keep components whole. The edges of a node
    meet in a pre-aggregated minimum and in a join with it, which streams them through one
    task: the aggregate has no exchange of its own, so adaptive execution does not split a hot node.
    The rounds end when the edges are stars; every round is written to the shared folder.
    """
    edges = staged(edges.filter("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").selectExpr("v AS u", "m AS v")
        edges = staged(small.unionByName(least.selectExpr("u", "m AS v")).distinct(), "edges")
        last, state = state, _state(edges)
        if state == last:
            roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            return edges.selectExpr("u AS node", "v AS root").unionByName(roots)
