"""SimHash near-dedup with a hierarchical index in Gray order.

Fingerprints that differ in few bits often lie near each other in Gray order.
Distinct fingerprints are range-partitioned and sorted by Gray rank and cut into
leaves. A leaf, and every `FAN` nodes in a row above it, is known by the bits that all its
members share. Two nodes whose shared bits differ in more places than allowed
cannot hold a link, so the self-join goes down from the root and drops whole
groups of pairs; what differs further down adds to what differed above. The index is exact: it
loses no link.

A node meets as many others as there are patterns within the allowed
distance of its own, whatever the data: fingerprints are distinct, so copies never crowd a node.
A leaf pair returns a spanning star of its links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from deedflow.llm.common import masked, staged, unmasked
from deedflow.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
LEAF = 256
FAN = 64
PIECE = 1 << 16
MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the hashes of word shingles, A-Z lower-cased, repeats included.

    A text of fewer words is one shingle; one without words is 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate([[0], ends[:-1]])
    size = min(shingle, len(words))
    spans = list(zip(starts[:len(words) - size + 1].tolist(), (ends[size - 1:] - 1).tolist()))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(spans), PIECE):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans[at:at + PIECE]], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id`, a hash of the text as `_text`, and `fp` as a signed long, for every row."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(text.as_py(), shingle) for text in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "_text", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"),
                       F.col("text").cast("binary").alias("_bytes"))
    return rows.mapInArrow(mark, "doc_id long, _text long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order, as a long in signed order."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _leaves(fps: DataFrame) -> DataFrame:
    """Sorted fingerprints cut into leaves: `node` in order, shared ones and zeros, members."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, rest = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)

        def leaf(values):
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([run], pa.int64()),
                pa.array([np.bitwise_and.reduce(values)]), pa.array([np.bitwise_or.reduce(values)]),
                pa.array([values.tobytes()], pa.binary())], ["part", "run", "every", "any", "members"])

        for batch in batches:
            rest = np.concatenate([rest, batch.column(0).to_numpy()])
            while len(rest) >= LEAF:
                yield leaf(rest[:LEAF])
                run, rest = run + 1, rest[LEAF:]
        if len(rest):
            yield leaf(rest)

    ordered = fps.select("fp", gray_rank(F.col("fp")).alias("_rank")).repartitionByRange("_rank").sortWithinPartitions("_rank")
    leaves = staged(ordered.select("fp").mapInArrow(
        cut, "part int, run long, every long, any long, members binary"), "gray-leaves")
    # One row per partition.
    counts = leaves.groupBy("part").count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["count"]
    offsets = leaves.sparkSession.createDataFrame(offsets, "part int, offset long")
    return leaves.join(F.broadcast(offsets), "part").selectExpr("offset + run AS node", "every", "any", "members"), total


def _bound(left, right) -> np.ndarray:
    """Least possible distances between the members of nodes, from (ones, any) patterns."""
    (a, b), (c, d) = left, right
    return np.bitwise_count((a[:, None] ^ c[None, :]) & ~(a ^ b)[:, None] & ~(c ^ d)[None, :])


def _descend(distance: int):
    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, seconds = [], []
            for left, right in zip(batch.column(0), batch.column(1)):
                (n, a, b), (m, c, d) = (
                    [np.array([kid[k] for kid in kids.as_py()], np.int64) for k in ("node", "every", "any")]
                    for kids in (left, right)
                )
                x, y = np.nonzero(_bound(*((p.view(np.uint64), q.view(np.uint64)) for p, q in ((a, b), (c, d)))) <= distance)
                kept = n[x] <= m[y]
                firsts.append(n[x][kept])
                seconds.append(m[y][kept])
            if firsts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts)), pa.array(np.concatenate(seconds))], ["a", "b"])
    return children


def _star(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Each linked fingerprint of two leaves with the least it reaches through their links."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= distance
    a, b = near.any(1), near.any(0)
    left, right, near = left[a], right[b], near[a][:, b]
    x, y = left.copy(), right.copy()
    while len(x):
        y2 = np.minimum(y, np.where(near, x[:, None], MOST).min(0))
        x2 = np.minimum(x, np.where(near, y2[None, :], MOST).min(1))
        if (x2 == x).all() and (y2 == y).all():
            break
        x, y = x2, y2
    nodes, roots = np.concatenate([left, right]), np.concatenate([x, y])
    kept = nodes != roots
    return nodes[kept], roots[kept]


def _matches(distance: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                _star(np.frombuffer(l.as_py(), np.uint64), np.frombuffer(r.as_py(), np.uint64), distance)
                for l, r in zip(batch.column(0), batch.column(1))
            ]
            u = np.concatenate([np.zeros(0, np.uint64), *[f[0] for f in found]])
            v = np.concatenate([np.zeros(0, np.uint64), *[f[1] for f in found]])
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])
    return links


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (`u`, `v`) that connect all distinct fingerprints within `distance` bits, directly or in steps."""
    spark = fps.sparkSession
    leaves, total = _leaves(fps)
    levels, nodes, count = [], leaves.select("node", "every", "any"), total
    while count > 1 or not levels:
        above = nodes.withColumn("up", F.expr(f"node div {FAN}")).groupBy("up").agg(
            F.expr("array_sort(collect_list(struct(node, every, any))) AS kids"),
            F.expr("bit_and(every) AS every"), F.expr("bit_or(any) AS any"),
        ).withColumnRenamed("up", "node")
        levels.append(above.select("node", "kids"))
        nodes, count = above.select("node", "every", "any"), -(-count // FAN)
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(levels):
        pairs = pairs.join(level.selectExpr("node AS a", "kids AS left"), "a").join(
            level.selectExpr("node AS b", "kids AS right"), "b"
        ).select("left", "right").mapInArrow(_descend(distance), "a long, b long")
    pairs = pairs.join(leaves.selectExpr("node AS a", "members AS left"), "a").join(
        leaves.selectExpr("node AS b", "members AS right"), "b"
    )
    # Pairs cost alike, so they are dealt evenly.
    return pairs.repartition("a", "b").select("left", "right").mapInArrow(_matches(distance), "u long, v long")


def clusters(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Every row as `doc_id`, `fp`, `component_id`, and `representative` of its group.

    Fingerprints within `distance` bits are linked, and so is whatever they
    reach. `component_id` is the smallest `doc_id` of the group, NULL if none has an
    id. The representative is the row of that id, by a hash of the text among
    repeated ids, as (`_null`, `_id`, `_text`). NULL and empty texts have
    fingerprint 0 and are a group like any other; no rows give no rows.
    """
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    return grouped(rows, "fp", lambda fps: links(fps, distance)).select(
        "doc_id", "_text", "fp", F.col("representative._id").alias("component_id"), "representative"
    )


def grouped(rows: DataFrame, key: str, linked_by: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Staged rows (`doc_id`, `_text`, `key`) with the `representative` of all keys that links connect."""
    first = F.struct(F.col("doc_id").isNull().alias("_null"), F.col("doc_id").alias("_id"), F.col("_text").alias("_text"))
    keys = staged(rows.groupBy(key).agg(F.min(first).alias("first")), "distinct-keys")
    roots = components(linked_by(keys)).select(F.col("node").alias(key), "root")
    linked = keys.join(roots, key)
    firsts = linked.groupBy("root").agg(F.min("first").alias("best"))
    best = linked.select(key, "root").join(firsts, "root").select(key, "best")
    # Written, so that the join of all rows has exchanges of its own and a hot key is split.
    named = staged(keys.join(best, key, "left").selectExpr(key, "coalesce(best, first) AS representative"), "groups")
    return rows.join(named, key)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs` that represent their group, once each, with all their columns."""
    return representing(docs, clusters(docs, shingle, distance))


def representing(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of `docs` that are a `representative` in `groups`, once each, with all their columns."""
    keys = ["_k_null", "_k_id", "_k_text"]
    kept = groups.select("representative").distinct().selectExpr(
        "representative._null AS _k_null", "coalesce(representative._id, 0L) AS _k_id",
        "representative._text AS _k_text")
    rows, names = masked(docs)
    doc_id, text = F.col(names["doc_id"]), F.col(names["text"])
    rows = rows.select(
        "*", doc_id.isNull().alias("_k_null"), F.coalesce(doc_id.cast("long"), F.lit(0)).alias("_k_id"),
        F.xxhash64(text).alias("_k_text"))
    return unmasked(rows.join(kept, keys, "left_semi").dropDuplicates(keys), names)
