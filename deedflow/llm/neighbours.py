"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions by seeded random directions, shifted, and
ordered along a Hilbert curve; every curve has directions and a shift of its own.
Spark range-partitions each order, and ranks along it cut it into blocks of
at most `BLOCK` rows. A query meets the rows at most a window away, in its own block and
those beside it, and the best of all curves are merged and ranked by the exact
inner product of the original vectors.

Vectors of another length span another space: each length is ordered and searched by itself.

Equal vectors are one point of the curve. A point keeps its smallest ids only,
as many as a result can show, so a vector shared by a third of all rows is one
row of the search and loses no neighbour.

The share of true neighbours found depends on the window against the table for
vectors without structure, and on structure otherwise. So the window is `WINDOW` rows, or `SHARE` of the
points if that is more: four curves of twice this share meet 92% of any table by chance alone. The work
grows with the square of a large table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from deedflow.llm.common import staged

NEAREST = 20
EVERY = 20
CURVES = 4
PROJECTED = 6
BITS = 10
# Rows on either side of a query: this many, and on larger tables a fixed share of the table.
WINDOW = 12_000
SHARE = 0.234
# Rows of a block, at most.
BLOCK = 12_000
SEED = 5


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell (rows of unsigned coordinates) along the Hilbert curve."""
    x = cells.astype(np.uint64).T.copy()
    count = len(x)
    one = np.uint64(1)
    bit = np.uint64(1 << (bits - 1))
    # From the coarsest bit down, undo the reflections and exchanges of the curve.
    while bit > one:
        low = bit - one
        for i in range(count):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        bit >>= one
    for i in range(1, count):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = np.uint64(1 << (bits - 1))
    while bit > one:
        turn = np.where((x[count - 1] & bit) != 0, turn ^ (bit - one), turn)
        bit >>= one
    x ^= turn
    keys = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for i in range(count):
            keys = (keys << one) | ((x[i] >> np.uint64(b)) & one)
    return keys


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a binary column of doubles."""
    return np.stack([np.frombuffer(v.as_py(), np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def points(vectors: DataFrame) -> DataFrame:
    """Usable rows as `vec_id`, packed `vector` and its hash `point`.

    NULL, empty and zero vectors and those that hold NULL or a non-finite number are left
    out, and so are rows without an id.
    """
    usable = F.expr(
        "size(embedding) > 0 AND forall(embedding, e -> e IS NOT NULL AND abs(e) < double('Infinity') AND NOT isnan(e))"
        " AND exists(embedding, e -> e <> 0)"
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter("vec_id IS NOT NULL").filter(usable)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [(np.array(v, np.float64) + 0.0).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["vec_id", "vector"])

    packed = rows.mapInArrow(pack, "vec_id long, vector binary").withColumn(
        "point", F.substring(F.sha2("vector", 256), 1, 32))
    return staged(packed, "vectors")


def reach(count: int) -> int:
    """Rows on either side of a query that keep the recall on a table of `count` points."""
    return max(WINDOW, math.ceil(SHARE * count))


@lru_cache(maxsize=64)
def _directions(curves: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes and shifts of all curves for vectors of a length."""
    rng = np.random.default_rng(SEED)
    return rng.standard_normal((curves, PROJECTED, size)) / np.sqrt(size), rng.random((curves, PROJECTED))


def _ordered(shapes: DataFrame, curves: int, spans: list[tuple[int, int]]) -> DataFrame:
    """Every point on every curve of its length: `point`, `curve`, `place` from 0.

    `spans` are the lengths of vectors with their numbers of points.
    """

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column(1))
            for length in pc.unique(lengths).to_pylist():
                part = batch.filter(pc.equal(lengths, length))
                size = length // 8
                axes, shifts = _directions(curves, size)
                matrix = _matrix(part.column(1))
                # Curves order directions; lengths count in the exact ranking.
                flat = matrix / np.abs(matrix).max(1, keepdims=True)
                flat /= np.linalg.norm(flat, axis=1, keepdims=True)
                for curve in range(curves):
                    spread = flat @ axes[curve].T * np.sqrt(size)
                    cells = np.clip((spread / 8 + 0.25 + shifts[curve] / 2) * (1 << BITS), 0, (1 << BITS) - 1)
                    keys = hilbert_keys(cells.astype(np.int64), BITS)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(np.full(len(matrix), size, np.int32)),
                         pa.array(np.full(len(matrix), curve, np.int32)), pa.array(keys.astype(np.int64))],
                        ["point", "size", "curve", "key"])

    keyed = shapes.select("point", "vector").mapInArrow(key, "point string, size int, curve int, key long")
    order = ["size", "curve", "key", "point"]
    ranged = staged(keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.monotonically_increasing_id().alias("_row")), "curve-order")
    # Row numbers have the partition above and the place in it below; a partition's offset makes them ranks.
    counts = ranged.groupBy(F.shiftright("_row", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["n"]
    starts, total = [], 0
    for size, count in spans:
        starts.append((size, total, count))
        total += curves * count
    spark = shapes.sparkSession
    offsets = spark.createDataFrame(offsets, "part long, offset long")
    starts = spark.createDataFrame(starts, "size int, start long, points long")
    # One row per partition, and one per length of vectors.
    return ranged.withColumn("part", F.shiftright("_row", 33)).join(F.broadcast(offsets), "part").join(
        F.broadcast(starts), "size").selectExpr(
        "point", "curve", f"offset + (_row & {(1 << 33) - 1}L) - start - curve * points AS place")


def neighbours(
    vectors: DataFrame, nearest: int = NEAREST, every: int = EVERY, curves: int = CURVES, window: int | None = None
) -> DataFrame:
    """For each query its `nearest` candidates found: `query_id`, `rank` from 1, `vec_id`, `score`.

    Queries are rows whose `vec_id` is divisible by `every`; candidates are all
    rows but the query's own. Without a `window` it follows from the table by `reach`. Scores are inner products in double precision; ties go to the
    smaller id. Vectors of different lengths do not meet. A row that repeats an id, or all of
    a row, is a query and a candidate of its own.
    """
    spark = vectors.sparkSession
    packed = points(vectors)
    # The rank limit works before the shuffle too, so that a hot vector sends few rows.
    place = F.row_number().over(Window.partitionBy("point").orderBy("vec_id"))
    ids = packed.select("point", "vec_id").withColumn("_place", place).filter(F.col("_place") <= nearest + 1)
    ids = ids.groupBy("point").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = packed.filter(F.pmod("vec_id", F.lit(every)) == 0)
    shapes = packed.groupBy("point").agg(
        F.first("vector").alias("vector"), F.max((F.pmod("vec_id", F.lit(every)) == 0).cast("int")).alias("asks")
    ).join(ids, "point")
    shapes = staged(shapes.withColumn("size", F.expr("CAST(octet_length(vector) div 8 AS int)")), "points")
    # One row per length of vectors.
    spans = [tuple(row) for row in shapes.groupBy("size").count().orderBy("size").collect()]
    if not spans:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    reaches = [(size, window or reach(count)) for size, count in spans]
    reaches = spark.createDataFrame([(size, n, min(n, BLOCK)) for size, n in reaches], "size int, reach long, rows long")
    ordered = _ordered(shapes, curves, spans)
    placed = ordered.join(shapes, "point").join(F.broadcast(reaches), "size").withColumn("block", F.expr("place div rows"))
    columns = ["size", "reach", "curve", "block", "place", "point", "vector"]
    targets = placed.select(*columns, "ids", F.lit(False).alias("asks"))
    queries = placed.filter("asks = 1").withColumn("block", F.explode(F.expr(
        "sequence(greatest(place - reach, 0L) div rows, (place + reach) div rows)"))).select(
        *columns, F.lit(None).cast("array<long>").alias("ids"), F.lit(True).alias("asks"))

    schema = pa.schema([
        ("query", pa.string()), ("point", pa.string()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])

    def search(key, table):
        asks = table.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
        target, query = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        if not target.num_rows or not query.num_rows:
            return schema.empty_table()
        window = key[1].as_py()
        matrix = _matrix(target.column("vector").combine_chunks())
        places = target.column("place").to_numpy()
        names = target.column("point").to_pylist()
        ids = target.column("ids").to_pylist()
        smallest = np.array([i[0] for i in ids], np.int64)
        out = []
        for at in range(0, query.num_rows, 64):
            part = query.slice(at, 64)
            wanted = _matrix(part.column("vector").combine_chunks())
            scores = wanted @ matrix.T
            far = np.abs(part.column("place").to_numpy()[:, None] - places) > window
            scores[far] = -np.inf
            for k, point in enumerate(part.column("point").to_pylist()):
                row = scores[k]
                # Points that could hold one of the nearest ids, ties included.
                limit = np.partition(row, -nearest - 1)[-nearest - 1] if len(row) > nearest + 1 else -np.inf
                least = limit - 1e-9 * abs(limit) if limit > -np.inf else limit
                near = np.flatnonzero((row >= least) & (row > -np.inf))
                # The sum of a pair's own products: the same in every block, unlike those of a matrix product.
                exact = (matrix[near] * wanted[k]).sum(1)
                best = np.lexsort((smallest[near], -exact))[:nearest + 1]
                out += [(point, names[near[j]], float(exact[j]), ids[near[j]]) for j in best]
        return pa.Table.from_arrays([pa.array([o[k] for o in out], schema.field(k).type) for k in range(4)], schema=schema)

    found = targets.unionByName(queries).groupBy("size", "reach", "curve", "block").applyInArrow(
        search, "query string, point string, score double, ids array<long>")
    found = found.groupBy("query", "point").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    expanded = found.select("query", "score", (F.col("query") == F.col("point")).alias("own"), F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "own")
    best = expanded.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= nearest + 1)
    lists = best.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("_place", "vec_id", "score", "own"))).alias("found"))
    # Written, so that the join has exchanges of its own and a hot vector's queries are split.
    lists = staged(lists, "neighbour-lists")
    # A query is one of the ids of its own point; leaving out that one entry, one more is at hand.
    answered = asked.select(F.col("vec_id").alias("query_id"), F.col("point").alias("query")).join(lists, "query")
    answered = answered.withColumn("self", F.expr(
        "array_position(transform(found, f -> f.own AND f.vec_id = query_id), true)"))
    return answered.select(
        "query_id", F.posexplode(F.expr(f"slice(filter(found, (f, i) -> i + 1 <> self), 1, {nearest})"))
    ).selectExpr("query_id", "pos + 1 AS rank", "col.vec_id AS vec_id", "col.score AS score")
