"""Running values over globally sorted rows, and sums along linked lists, without gathering a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import staged

# Running sums are kept modulo 2 ** 62, so that the sum of two never overflows.
MASK = (1 << 62) - 1
# Arcs that one task holds at a time, on average.
TASK_ARCS = 1 << 17
# A list this short is finished in one task.
SHORT = 1 << 16
PIECE = 1 << 16


def scanned(
    df: DataFrame, group: str, order: Sequence[str], name: str, sums: Sequence[str] = (), lag: str | None = None
) -> DataFrame:
    """All rows, staged in order of `group` and `order`, with running values.

    Adds `_at`, the place among all rows from 0, and `_pos`, the place in the
    group from 1; replaces each of `sums` by its running sum in the group, modulo
    2 ** 62; adds `_lag`, the value of `lag` in the row before of the group, if asked. Columns
    named here are longs without NULL. Rows are range-partitioned, so a large group is
    spread over tasks, each of which streams; one row per partition, with its last
    values, passes through the driver. Rows equal in all of `order` keep any order.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    names = rows.columns
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)
    schema = f"{fields}, _part int, _run long, _pos long" + (", _lag long" if lag else "")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, before, pos, running, behind = TaskContext.get().partitionId(), 0, None, 0, [0] * len(sums), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups, place = batch.column(names.index(group)).to_numpy(), np.arange(n)
            first = np.empty(n, bool)
            first[0] = before is None or groups[0] != before
            first[1:] = groups[1:] != groups[:-1]
            start = np.maximum.accumulate(np.where(first, place, -1))
            positions = place - start + np.where(start < 0, pos, 1)
            columns = dict(zip(names, batch.columns))
            for k, column in enumerate(sums):
                total = np.cumsum(columns[column].to_numpy().astype(np.uint64), dtype=np.uint64)
                earlier = np.where(start > 0, total[start - 1], np.uint64(0))
                total = (total - earlier + np.where(start < 0, np.uint64(running[k]), np.uint64(0))) & np.uint64(MASK)
                running[k] = int(total[-1])
                columns[column] = pa.array(total.astype(np.int64))
            out = [*columns.values(), pa.array(np.full(n, part, np.int32)), pa.array(run + place), pa.array(positions)]
            if lag:
                values = columns[lag].to_numpy()
                shifted = np.concatenate([[0 if behind is None else behind], values[:-1]])
                out.append(pa.array(shifted, pa.int64(), mask=positions == 1))
                behind = int(values[-1])
            run, before, pos = run + n, groups[-1], int(positions[-1])
            yield pa.RecordBatch.from_arrays(out, [*names, "_part", "_run", "_pos", *(["_lag"] if lag else [])])

    table = staged(rows.mapInArrow(mark, schema), name)
    ends = table.groupBy("_part").agg(
        F.count(F.lit(1)).alias("rows"), F.min(group).alias("first"), F.max(group).alias("last"),
        F.max_by(F.struct("_pos", *sums, *([lag] if lag else [])), "_run").alias("end"),
    ).orderBy("_part").collect()
    carried, at, carry = [], 0, None
    for end in ends:
        carried.append((end["_part"], at, *(carry or (None, 0, [0] * len(sums), None))))
        values = tuple(end["end"])
        pos, totals = values[0], list(values[1:1 + len(sums)])
        if carry and end["first"] == end["last"] == carry[0]:
            pos, totals = pos + carry[1], [(a + b) & MASK for a, b in zip(totals, carry[2])]
        carry = (end["last"], pos, totals, values[-1] if lag else None)
        at += end["rows"]
    offsets = df.sparkSession.createDataFrame(
        carried, "_part int, _offset long, _group long, _more long, _sums array<long>, _behind long")
    goes_on = f"(_group IS NOT NULL AND `{group}` = _group)"
    columns = {name: f"`{name}`" for name in names}
    for k, column in enumerate(sums):
        columns[column] = f"if({goes_on}, (`{column}` + _sums[{k}]) & {MASK}L, `{column}`) AS `{column}`"
    # One row per partition.
    joined = table.join(F.broadcast(offsets), "_part")
    return joined.selectExpr(
        *columns.values(), "_offset + _run AS _at", f"if({goes_on}, _pos + _more, _pos) AS _pos",
        *([f"if({goes_on} AND _run = 0, _behind, _lag) AS _lag"] if lag else []))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the arcs of a task to the longest paths that lie in it."""
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    ids, nexts, first, second = (table.column(k).to_numpy() for k in range(4))
    order = np.argsort(ids)
    ids, nexts = ids[order], nexts[order]
    weights = np.stack([first[order], second[order]])
    at = np.minimum(np.searchsorted(ids, nexts), len(ids) - 1)
    local = ids[at] == nexts
    # `head` goes back over ever longer stretches; a head points to itself.
    head = np.arange(len(ids))
    head[at[local]] = np.nonzero(local)[0]
    offset = np.where(head == np.arange(len(ids)), 0, weights[:, head])
    while (head[head] != head).any():
        offset, head = offset + offset[:, head], head[head]
    tails = np.nonzero(~local)[0]
    after, total = np.full(len(ids), -1), np.zeros_like(weights)
    after[head[tails]] = nexts[tails]
    total[:, head[tails]] = offset[:, tails] + weights[:, tails]
    columns = [ids, ids[head], *offset, after, *total]
    for start in range(0, len(ids), PIECE):
        yield pa.RecordBatch.from_arrays(
            [pa.array(column[start:start + PIECE]) for column in columns],
            ["id", "head", "before1", "before2", "next", "w1", "w2"])


def list_sums(arcs: DataFrame) -> DataFrame:
    """`id`, `before1`, `before2`: sums of the weights of all arcs before an arc of a linked list.

    `arcs` has `id`, `next` (-1 for the last), `w1` and `w2`, in any order. Paths of
    arcs that meet in a task become one arc of a shorter list, until one task holds
    the rest; then sums are handed down again. The first round brings neighbouring
    ids together. In later ones, arcs by a coin of their own move to the
    successor, so that a quarter of them is expected to be absorbed however the list lies; the
    whole work stays in proportion to the list.
    """
    rounds, rest = [], arcs
    while True:
        count = rest.count()
        tasks = -(-count // TASK_ARCS)
        if count <= SHORT:
            placed = rest.repartition(1)
        elif not rounds:
            placed = rest.repartitionByRange(tasks, "id")
        else:
            coin = f"pmod(xxhash64({{}}, {len(rounds)}), 2)"
            meet = f"if({coin.format('id')} = 1 AND {coin.format('next')} = 0, next, id)"
            placed = rest.repartition(tasks, F.expr(meet))
        placed = placed.select("id", "next", "w1", "w2").mapInArrow(
            _paths, "id long, head long, before1 long, before2 long, next long, w1 long, w2 long")
        rounds.append(staged(placed, "list-round"))
        if count <= SHORT:
            break
        rest = rounds[-1].filter("id = head").select("id", "next", "w1", "w2")
    sums = rounds.pop().select("id", "before1", "before2")
    for level in reversed(rounds):
        heads = sums.selectExpr("id AS head", "before1 AS s1", "before2 AS s2")
        sums = level.join(heads, "head").selectExpr("id", "before1 + s1 AS before1", "before2 + s2 AS before2")
    return sums
