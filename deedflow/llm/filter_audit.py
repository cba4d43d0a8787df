"""What each of several filters removes, alone and in every order, from a sparse document-term matrix.

Tasks build shards of the matrix in compressed sparse rows with a vocabulary
of their own. The words of all vocabularies meet once, by word, and get the
numbers of one dictionary; each shard is then built anew with these numbers. Only
vocabularies and shards are shuffled, never single words of texts. Row sums (words) and numbers of
nonzeros (different words) decide two of the filters; the rest are flags of the text.

Which filters a document fails is a mask of five bits, and a part of the table has at most
32 of them. All orders are evaluated on these counts.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import UPPER, staged

FILTERS = "ABCDE"
FEW_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = "#$%&*|"
# A shard is closed when it has so many words in its vocabulary, nonzeros or rows.
SHARD_WORDS, SHARD_NONZEROS, SHARD_ROWS = 1 << 17, 1 << 20, 1 << 14
# Texts that are turned into Python objects at a time.
PIECE = 64

ROWS = "doc_ids array<long>, langs array<string>, digests array<binary>, flags array<int>"
MATRIX = f"{ROWS}, starts binary, indices binary, counts binary"


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in little space: steps from one to the next, equal bytes of all steps side by side."""
    steps = values - np.concatenate([np.zeros(1, values.dtype), values[:-1]])[:len(values)]
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).reshape(-1), dtype=kind)


def _stored(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


class _Shard:
    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.rows, self.indices, self.counts, self.nonzeros = [], [], [], 0

    def add(self, doc_id, lang, text: bytes, points: int) -> None:
        counted, place = Counter(text.split()), self.words
        local = np.fromiter((place.setdefault(word, len(place)) for word in counted), np.uint32, len(counted))
        order = np.argsort(local)
        self.indices.append(local[order])
        self.counts.append(np.fromiter(counted.values(), np.uint32, len(counted))[order])
        capitals = len(text) - len(text.translate(None, UPPER.encode()))
        marked = len(text) != len(text.translate(None, SYMBOLS.encode()))
        flags = 4 * (100 * capitals > CAPITAL_PERCENT * points) + 8 * marked
        self.rows.append((doc_id, lang, hashlib.blake2b(text, digest_size=16).digest(), flags))
        self.nonzeros += len(counted)

    def full(self) -> bool:
        return len(self.words) >= SHARD_WORDS or self.nonzeros >= SHARD_NONZEROS or len(self.rows) >= SHARD_ROWS

    def batch(self, part: int, run: int) -> pa.RecordBatch:
        starts = np.concatenate([[0], np.cumsum([len(row) for row in self.indices])]).astype(np.uint64)
        ids, langs, digests, flags = zip(*self.rows)
        columns = {
            "doc_ids": pa.array([ids], pa.list_(pa.int64())), "langs": pa.array([langs], pa.list_(pa.string())),
            "digests": pa.array([digests], pa.list_(pa.binary())), "flags": pa.array([flags], pa.list_(pa.int32())),
            "starts": pa.array([packed(starts)]), "indices": pa.array([packed(np.concatenate(self.indices))]),
            "counts": pa.array([packed(np.concatenate(self.counts))]),
        }
        # One value, as many NULL lists beside it would cost the exchange with Python the square of their number.
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([run], pa.int32()), pa.array([_stored(pa.RecordBatch.from_pydict(columns))]),
             pa.array([list(self.words)], pa.list_(pa.binary()))], ["part", "run", "shard", "words"])


def _local_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, run, shard = TaskContext.get().partitionId(), 0, _Shard()
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            for row in zip(*(column.to_pylist() for column in batch.slice(at, PIECE).columns)):
                shard.add(*row)
                if shard.full():
                    yield shard.batch(part, run)
                    run, shard = run + 1, _Shard()
    if shard.rows:
        yield shard.batch(part, run)


def _words_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the different words of a sorted partition; of each word only the first row keeps its text."""
    part, last, run = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column("word")
        new = pa.concat_arrays([
            pa.array([last != words[0].as_py()]), pc.not_equal(words.slice(1), words.slice(0, len(words) - 1))])
        runs = run + np.cumsum(new.to_numpy(zero_copy_only=False))
        last, run = words[-1].as_py(), int(runs[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("run"), batch.column("local"), pc.if_else(new, words, pa.scalar(None, words.type)),
             pa.array(np.full(len(words), part, np.int32)), pa.array(runs)],
            ["part", "run", "local", "word", "_part", "_run"])


def _renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with global numbers; before each come the rows of its vocabulary."""
    places, numbers = [], []
    for batch in batches:
        place, number = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("local", "term"))
        shards, at = batch.column("shard"), 0
        for row in np.flatnonzero(shards.is_valid().to_numpy(zero_copy_only=False)):
            places.append(place[at:row])
            numbers.append(number[at:row])
            known = np.concatenate(places)
            terms = np.zeros(len(known), np.uint64)
            terms[known] = np.concatenate(numbers).astype(np.uint64)
            places, numbers, at = [], [], row + 1
            (shard,) = pa.ipc.open_stream(shards[row].as_py())
            local = unpacked(shard.column("indices")[0].as_py(), np.uint32)
            at_indices = shard.schema.get_field_index("indices")
            yield shard.set_column(at_indices, "indices", pa.array([packed(terms[local])]))
        places.append(place[at:])
        numbers.append(number[at:])


def term_matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dictionary (`word`, `term` from 0 without gaps) and the matrix in shards of rows.

    A shard has the rows' `doc_ids`, `langs`, `digests` of the texts and `flags`, and `starts`, `indices` and
    `counts` in packed form (`unpacked`, of 64, 64 and 32 bits). Words are what stands between white space. NULL is an empty text, which has
    an empty row.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).select("doc_id", "lang", F.col("text").cast("binary").alias("text"), F.length("text").alias("points"))
    shards = staged(rows.mapInArrow(_local_shards, "part int, run int, shard binary, words array<binary>"), "local-shards")
    # A word comes once per shard at most, however frequent it is.
    words = shards.select("part", "run", F.posexplode("words").alias("local", "word"))
    words = words.repartition("word").sortWithinPartitions("word").mapInArrow(
        _words_in_order, "part int, run int, local int, word binary, _part int, _run long")
    words = staged(words, "dictionary")
    # One row per partition.
    offsets, at = [], 0
    for row in words.groupBy("_part").agg(F.max("_run").alias("last")).orderBy("_part").collect():
        offsets.append((row["_part"], at))
        at += row["last"] + 1
    offsets = F.broadcast(docs.sparkSession.createDataFrame(offsets, "_part int, _offset long"))
    known = words.join(offsets, "_part").selectExpr("part", "run", "local", "_offset + _run AS term", "word")
    dictionary = known.filter("word IS NOT NULL").select("word", "term")
    # The rows of a shard's vocabulary, then the shard.
    key = "shiftleft(CAST(part AS long), 32) + 2L * run"
    both = known.selectExpr(f"{key} AS key", "local", "term", "CAST(NULL AS binary) AS shard").unionByName(
        shards.selectExpr(f"{key} + 1 AS key", "0 AS local", "0L AS term", "shard"))
    matrix = both.repartition(F.expr("key div 2")).sortWithinPartitions("key").select("local", "term", "shard").mapInArrow(
        _renumbered, MATRIX)
    return dictionary, matrix


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in batch.schema.names}
            starts = unpacked(row["starts"].as_py(), np.uint64).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(unpacked(row["counts"].as_py(), np.uint32), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [*(row[name].values for name in ("doc_ids", "langs", "digests", "flags")),
                 pa.array(total[starts[1:]] - total[starts[:-1]]), pa.array(np.diff(starts))],
                ["doc_id", "lang", "digest", "flags", "n_words", "n_distinct"])


def failures(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: `doc_id`, `lang`, `digest` of the text and a mask of the filters A to D that it fails."""
    measured = term_matrix(docs)[1].mapInArrow(
        _measured, "doc_id long, lang string, digest binary, flags int, n_words long, n_distinct long")
    return measured.selectExpr(
        "doc_id", "coalesce(lang, '') AS part", "digest",
        f"flags | if(n_words < {FEW_WORDS}, 1, 0) | if(100 * n_distinct < {DISTINCT_PERCENT} * n_words, 2, 0) AS mask")


def failing_groups(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Numbers of documents per `part` and `mask` of failed filters: `n`, of these `good` and `toxic` ones.

    Equal texts lie in one group by digest, counted before they meet. A document without id never fails E and no
    other fails because of it; repeated rows of the smallest id of a text do not fail it either. A
    document is good or toxic if any of its labels says so.
    """
    # Rows without id are dealt by text, so that they do not meet in one task.
    folded = failures(docs).groupBy("digest", "part", "mask", "doc_id").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "*", "coalesce(doc_id, xxhash64(digest)) AS _id", "doc_id IS NULL AS _none")
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.expr("max(coalesce(quality = 1, false)) AS good"), F.expr("max(coalesce(toxic = 1, false)) AS toxic")
    ).withColumn("_none", F.lit(False))
    same = folded.join(marks, ["_id", "_none"], "left").groupBy(
        "digest", "part", "mask", F.expr("coalesce(good, false)").alias("good"), F.expr("coalesce(toxic, false)").alias("toxic")
    ).agg(
        F.sum("n").alias("n"), F.expr("sum(if(_none, n, 0L)) AS unnamed"),
        F.expr("min(if(_none, NULL, struct(doc_id, n))) AS least"))
    # A text has a row per part and kind of label here.
    split = same.selectExpr("*", "min(least.doc_id) OVER (PARTITION BY digest) AS first").selectExpr(
        "part", "mask", "good", "toxic", "n", "n - unnamed - if(least.doc_id = first, least.n, 0L) AS copies_")
    split = split.withColumn("copies", F.coalesce("copies_", F.lit(0)))
    return split.selectExpr(
        "part", "good", "toxic", "inline(array(struct(mask, n - copies AS n), struct(mask | 16 AS mask, copies AS n)))"
    ).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.expr("sum(if(good, n, 0L)) AS good"), F.expr("sum(if(toxic, n, 0L)) AS toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: what the step removes, misses and costs.

    Columns: `part`, `filter_order`, `step`, `kept`, `removed`, `redundant`, `unique_fails`,
    `good_lost`, `toxic_lost`, `shapley`. No documents give no rows. Other columns are not looked at.
    """
    bit = {letter: 1 << k for k, letter in enumerate(FILTERS)}
    steps = [
        f"struct('{''.join(order)}' AS filter_order, {k + 1} AS step, {bit[letter]} AS own, {sum(bit[l] for l in order[:k])} AS earlier)"
        for order in itertools.permutations(FILTERS) for k, letter in enumerate(order)
    ]
    # At most one entry per mask.
    parts = failing_groups(docs, labels).groupBy("part").agg(F.expr("collect_list(struct(mask, n, good, toxic)) AS masks"))
    steps = parts.selectExpr("*", f"inline(array({', '.join(steps)}))")

    def total(value: str, condition: str, name: str) -> str:
        return f"aggregate(masks, 0L, (s, e) -> s + if({condition}, {value}, 0L)) AS {name}"

    now = "(e.mask & own) <> 0 AND (e.mask & earlier) = 0"
    return steps.selectExpr(
        "part", "filter_order", "step",
        total("e.n", "(e.mask & (own | earlier)) = 0", "kept"),
        total("e.n", now, "removed"),
        total("e.n", "(e.mask & own) <> 0 AND (e.mask & earlier) <> 0", "redundant"),
        total("e.n", "e.mask = own", "unique_fails"),
        total("e.good", now, "good_lost"),
        total("e.toxic", now, "toxic_lost"),
        # In how many orders the filter comes first among those that a document fails.
        total("e.n * (120L div bit_count(e.mask))", "(e.mask & own) <> 0", "shapley"))
