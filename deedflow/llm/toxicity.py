"""Toxicity by a convolutional text classifier, trained in numpy.

Words and their beginnings are hashed into one embedding table, and a word is the
sum of its parts, so that inflected forms share what is learned. Filters of several widths slide over
the words, the strongest response of each filter over the whole text is kept, and
a logistic layer turns these into a score. Max pooling sends the gradient of a
text to the strongest windows alone, so a step touches few rows of the table.

Training starts from a model of a few labelled rows and takes passes over all of them: tasks learn from their own
rows, and the changes are averaged. Scoring runs over whole texts in Arrow batches. Thresholds are
calibrated by language on a fifth of all labelled rows, which the model has not seen until then.
"""

from __future__ import annotations

import copy
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from deedflow.llm.common import masked, staged, unmasked

BUCKETS = 1 << 17
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
# Rows of each label, at most, that the first model learns from, before the pass over all labelled rows.
SAMPLE = 2000
# Labelled rows that one task of the pass learns from, and rows of the table whose changes are averaged together.
TASK_ROWS = 4096
BLOCK = 1 << 13
# Labelled ids that may be broadcast.
BROADCAST_IDS = 1 << 19
# Steps of a score's logarithmic odds in which calibrating rows are counted.
ODDS = 64
# Words that are in memory at once while scoring; a longer text is pooled piece by piece.
PIECE = 1 << 15
# Steps of the first model.
STEPS = 320
BATCH = 32
SEED = 11
# Toxic rows at which a calibrated threshold counts half.
STEADY = 30
FOLDS = 5
STRIP = ".,;:!?\"'()[]*$#&%|"
PAD = max(WIDTHS) - 1
REMEMBERED = 300_000

# Beginnings of a word in characters; a whole word comes first.
PREFIXES = (4, 6)
PARTS = 1 + len(PREFIXES)

# CRC-32 goes on from the checksum of what comes before, so the mark of a part is hashed once.
WHOLE = zlib.crc32(b"w")
MARKS = [(n, zlib.crc32(b"%d" % n)) for n in PREFIXES]


class Places(dict):
    """Place of each word in `parts`, which holds the buckets of its parts; a new word is added when it is looked up."""

    def __init__(self):
        self.parts = array("i")

    def __missing__(self, word: str) -> int:
        self.parts.extend(_parts(word))
        place = self[word] = len(self)
        return place

    def forget(self) -> None:
        self.clear()
        self.parts = array("i")


_PLACES = Places()


def _parts(word: str) -> list[int]:
    word = word.strip(STRIP)
    whole = word.encode("utf-8", "replace")
    buckets = [zlib.crc32(whole, WHOLE) % (BUCKETS - 1) + 1]
    plain = word.isascii()
    for n, mark in MARKS:
        part = whole[:n] if plain else word[:n].encode("utf-8", "replace")
        buckets.append(zlib.crc32(part, mark) % (BUCKETS - 1) + 1)
    return buckets


def word_ids(texts: list[str | None]) -> list[np.ndarray]:
    """Buckets of the words of each text, one row per word.

    Words are lower-cased and lose punctuation at their ends. 0 is kept for padding.
    """
    if len(_PLACES) > REMEMBERED:
        _PLACES.forget()
    place = _PLACES.__getitem__
    places = []
    for text in texts:
        words = (text or "").lower().split()
        places.append(np.fromiter(map(place, words), np.int64, len(words)))
    # A copy, as an array cannot grow while numpy looks at it.
    parts = np.array(_PLACES.parts, np.int32).reshape(-1, PARTS)
    return [parts.take(at, axis=0) for at in places]


class Model:
    """Parameters; `pooled` gives the strongest responses of each text."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.table = (rng.standard_normal((BUCKETS, DIMENSIONS)) * 0.05).astype(np.float32)
        self.table[0] = 0
        self.filters = {w: (rng.standard_normal((w * DIMENSIONS, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS}
        self.biases = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32)
        self.shift = np.float32(0)
        # Sums of squared gradients set the step of each parameter.
        self.squares: dict[str, np.ndarray] = {}

    def words(self, ids: np.ndarray) -> np.ndarray:
        rows = self.table.take(ids[:, 0], axis=0)
        for k in range(1, PARTS):
            rows += self.table.take(ids[:, k], axis=0)
        return rows

    def pooled(self, texts: list[np.ndarray], positions: bool = False):
        """Responses (texts x filters) and where they are; texts are joined with padding between."""
        padding = np.zeros((PAD, PARTS), np.int32)
        sizes = np.array([max(len(t), 1) for t in texts])
        starts = np.cumsum(sizes + PAD) - sizes - PAD
        # Windows begin at words of their text, never at padding, so that no text sees the next.
        edges = np.stack([starts, starts + sizes], axis=1).reshape(-1)[:-1]
        ids = np.concatenate([np.concatenate([t if len(t) else padding[:1], padding]) for t in texts])
        values, places = [], []
        words = self.words(ids)
        for width in WIDTHS:
            answers = self.biases[width] + words[:len(words) - PAD] @ self.filters[width][:DIMENSIONS]
            for j in range(1, width):
                kernel = self.filters[width][j * DIMENSIONS:(j + 1) * DIMENSIONS]
                answers += words[j:len(words) - PAD + j] @ kernel
            values.append(np.maximum.reduceat(answers, edges, axis=0)[::2])
            if positions:
                places.append(np.stack([s + answers[s:s + n].argmax(0) for s, n in zip(starts, sizes)]))
        return np.maximum(np.concatenate(values, axis=1), 0), places, ids

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores of whole texts; a long text is pooled over overlapping pieces."""
        pieces, owner = [], []
        for k, text in enumerate(texts):
            for at in range(0, max(len(text), 1), PIECE):
                pieces.append(text[at:at + PIECE + PAD])
                owner.append(k)
        best = np.zeros((len(texts), len(self.out)), np.float32)
        at = 0
        while at < len(pieces):
            to, size = at, 0
            while to < len(pieces) and (to == at or size + len(pieces[to]) <= PIECE):
                size += len(pieces[to])
                to += 1
            values = self.pooled(pieces[at:to])[0]
            np.maximum.at(best, owner[at:to], values)
            at = to
        raw = np.clip((best @ self.out + self.shift).astype(np.float64), -30, 30)
        return 1 / (1 + np.exp(-raw))


def _step(model: Model, texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """One adaptive step on the logistic loss of a few texts; the rows of the table that it changes."""
    def step(name, value, gradient, rate, rows=None):
        total = model.squares.setdefault(name, np.full(value.shape, 1e-2, np.float32))
        if rows is None:
            total += gradient**2
            value -= rate * gradient / np.sqrt(total)
        else:
            total[rows] += gradient**2
            value[rows] -= rate * gradient / np.sqrt(total[rows])

    pooled, places, ids = model.pooled(texts, positions=True)
    raw = np.clip(pooled @ model.out + model.shift, -30, 30)
    error = (1 / (1 + np.exp(-raw)) - labels).astype(np.float32)
    back = np.outer(error, model.out) * (pooled > 0)
    step("out", model.out, pooled.T @ error, 0.1)
    shift = np.array([model.shift])
    step("shift", shift, np.array([error.sum()], np.float32), 0.1)
    model.shift = shift[0]
    touched, changes = [], []
    for n, width in enumerate(WIDTHS):
        part = back[:, n * FILTERS:(n + 1) * FILTERS]
        where = places[n][:, :, None] + np.arange(width)
        rows = model.table[ids[where]].sum(3).reshape(len(texts), FILTERS, width * DIMENSIONS)
        kernel = model.filters[width]
        change = (part[:, :, None] * kernel.T[None]).reshape(-1, DIMENSIONS)
        changes.append(np.repeat(change, PARTS, axis=0))
        touched.append(ids[where].reshape(-1))
        step(f"f{width}", kernel, np.einsum("tf,tfd->df", part, rows), 0.05)
        step(f"b{width}", model.biases[width], part.sum(0), 0.05)
    touched, changes = np.concatenate(touched), np.concatenate(changes)
    kept = (np.abs(changes).sum(1) > 0) & (touched > 0)
    unique, inverse = np.unique(touched[kept], return_inverse=True)
    summed = np.zeros((len(unique), DIMENSIONS), np.float32)
    np.add.at(summed, inverse, changes[kept])
    step("table", model.table, summed, 0.1, unique)
    return unique


def train(texts: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Model:
    """A new model after some steps; each pass over the texts is in a new seeded order."""
    model = Model(seed)
    rng = np.random.default_rng(seed + 1)
    taken = 0
    while taken < steps:
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            taken += 1
            if taken > steps:
                break
            _step(model, [texts[k] for k in chosen], labels[chosen])
    return model


def _small(model: Model) -> list[np.ndarray]:
    """All parameters but the table."""
    return [model.out, *model.filters.values(), *model.biases.values()]


def _passed(shared):
    """One pass of a task over its rows, from the shared model: what it changes, in blocks of the table."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, touched, texts, labels, size = None, np.zeros(BUCKETS, bool), [], [], 0
        for batch in batches:
            if model is None:
                first = shared.value
                model = copy.deepcopy(first)
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                for ids, label in zip(word_ids(part.column(0).to_pylist()), part.column(1).to_pylist()):
                    texts.append(ids)
                    labels.append(label)
                    size += len(ids)
                    if len(texts) == BATCH or size >= PIECE:
                        touched[_step(model, texts, np.array(labels, np.float32))] = True
                        texts, labels, size = [], [], 0
        if texts:
            touched[_step(model, texts, np.array(labels, np.float32))] = True
        if model is None:
            return
        rows = np.flatnonzero(touched)
        change = model.table[rows] - first.table[rows]
        edges = np.searchsorted(rows, np.arange(0, BUCKETS + 1, BLOCK))
        small = np.concatenate([*[(new - old).reshape(-1) for new, old in zip(_small(model), _small(first))],
                                [model.shift - first.shift]]).astype(np.float32)
        blocks = [-1, *range(BUCKETS // BLOCK)]
        places = [np.arange(len(small)), *[rows[s:e] - k * BLOCK for k, (s, e) in enumerate(zip(edges, edges[1:]))]]
        values = [small, *[change[s:e] for s, e in zip(edges, edges[1:])]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([p.astype(np.int32).tobytes() for p in places], pa.binary()),
             pa.array([v.tobytes() for v in values], pa.binary())], ["block", "places", "changes"])
    return learn


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean change of each row of a block over the tasks that changed it."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, places, changes in zip(*(batch.column(k).to_pylist() for k in range(3))):
            places = np.frombuffer(places, np.int32)
            width = 1 if block < 0 else DIMENSIONS
            if block not in sums:
                length = len(places) if block < 0 else BLOCK
                sums[block] = np.zeros((length, width)), np.zeros((length, 1))
            sums[block][0][places] += np.frombuffer(changes, np.float32).reshape(-1, width)
            sums[block][1][places] += 1
    for block, (total, count) in sums.items():
        mean = (total / np.maximum(count, 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["block", "mean"])


def refine(model: Model, rows: DataFrame, count: int) -> Model:
    """The model after a pass over all `rows` (`text`, `_toxic`, `_order`), `count` of them.

    Tasks learn from their own rows, each from the same model, and their changes are averaged block by block. A task
    takes some `TASK_ROWS` rows in the order of a hash, so neither its share nor its memory grows with the table.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    # Fixed by the rows alone, so that a rerun learns the same.
    dealt = rows.repartition(max(1, -(-count // TASK_ROWS)), "_order").sortWithinPartitions("_order", "_toxic")
    changes = dealt.select("text", "_toxic").mapInArrow(_passed(shared), "block int, places binary, changes binary")
    means = changes.repartition("block").mapInArrow(_averaged, "block int, mean binary")
    # As many values as the model has.
    means = {row["block"]: np.frombuffer(row["mean"], np.float32) for row in means.collect()}
    # The driver's copy goes too.
    shared.destroy()
    if means:
        small = means.pop(-1)
        model.shift = np.float32(model.shift + small[-1])
        at = 0
        for values in _small(model):
            values += small[at:at + values.size].reshape(values.shape)
            at += values.size
    for block, mean in means.items():
        model.table[block * BLOCK:(block + 1) * BLOCK] += mean.reshape(-1, DIMENSIONS)
    return model


def best_threshold(scores: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None) -> float:
    """The threshold with the least loss, a false alarm counting as two misses.

    `times` says how many rows each score and label stand for.
    Of equally good thresholds the nearest to 0.5 is taken, and few toxic rows
    move it little.
    """
    if not len(scores) or labels.min() == labels.max():
        return 0.5
    order = np.argsort(scores, kind="stable")
    s, n = scores[order], np.ones(len(scores), np.int64) if times is None else times[order]
    y = labels[order] * n
    missed = np.concatenate([[0], np.cumsum(y)])
    alarms = (n - y).sum() - np.concatenate([[0], np.cumsum(n - y)])
    low, high = np.concatenate([[0.01], s]), np.concatenate([s, [0.99]])
    loss = missed + 2 * alarms
    # A threshold at the edge of its gap moves to the middle.
    inside = np.where((low < 0.5) & (0.5 < high), 0.5, (low + high) / 2)
    # Equal scores stay together.
    apart = np.concatenate([[True], s[1:] != s[:-1], [True]])
    ties = np.flatnonzero(apart & (loss == loss[apart].min()))
    chosen = np.clip(inside[ties[np.argmin(np.abs(inside[ties] - 0.5))]], 0.01, 0.99)
    weight = y.sum() / (y.sum() + STEADY)
    return float(1 / (1 + np.exp(-weight * np.log(chosen / (1 - chosen)))))


def untrained() -> Model:
    """A model that gives every text the same score, below 0.5."""
    model = Model()
    model.out[:] = 0
    model.shift = np.float32(-1)
    return model


def fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _labelled(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """Every labelled id outside of the held-out fold that has a row: `text`, `_lang`, `_toxic`, `_order`.

    Of rows with one id the one with the smallest text hash is taken.
    """
    marked = labels.filter("toxic IN (0, 1)").filter(fold(folds) != 0).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("_toxic"))
    marked = staged(marked.withColumn("_order", F.xxhash64(F.lit(SEED), "doc_id")), "marked")
    # Few labels spare the texts a shuffle.
    few = marked.count() <= BROADCAST_IDS
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("_lang")).join(
        F.broadcast(marked) if few else marked, "doc_id")
    # An id that many rows share is learned from once.
    rows = rows.groupBy("doc_id", "_toxic", "_order").agg(
        F.min_by(F.struct("text", "_lang"), F.struct(F.xxhash64("text"), "_lang")).alias("_row"))
    return staged(rows.select("_row.text", "_row._lang", "_toxic", "_order"), "labelled")


def _histogram(rows: DataFrame, model: Model) -> list:
    """Number of rows by language, label and score, scores in steps of their logarithmic odds."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = np.clip(shared.value.scores(word_ids(part.column(0).to_pylist())), 1e-9, 1 - 1e-9)
                steps = np.rint(ODDS * np.log(values / (1 - values))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(steps)], ["lang", "toxic", "step"])

    scored = rows.select("text", "_lang", "_toxic").mapInArrow(score, "lang string, toxic int, step int")
    counted = scored.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), "toxic", "step").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.collect()
    shared.destroy()
    return counted


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> tuple[Model, dict[str, float]]:
    """Model and thresholds by language from all labelled rows outside of the held-out fold.

    A first model of `sample` rows of each label at most is the start of a pass over four fifths of the ids, by a
    hash. The other fifth, all of it, calibrates the thresholds; then a pass over all rows ends the training.
    Without both labels the model rejects nothing.
    """
    rows = _labelled(docs, labels, folds)
    known = "pmod(_order, 5) = 0"

    def numbers(df: DataFrame) -> dict[int, int]:
        return {row["_toxic"]: row["count"] for row in df.groupBy("_toxic").count().collect()}

    every, learned = numbers(rows), numbers(rows.filter(f"NOT ({known})"))
    if len(every) < 2:
        return untrained(), {}
    # Too few rows to spare some.
    learn = rows.filter(f"NOT ({known})") if len(learned) == 2 else rows
    learned = learned if len(learned) == 2 else every
    first = learn.select("_toxic", "_order")
    first = first.filter("_toxic = 1").orderBy("_order").limit(sample).unionByName(
        first.filter("_toxic = 0").orderBy("_order").limit(sample))
    first = learn.join(F.broadcast(first.select("_order")), "_order").select("text", "_toxic", "_order")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [ids.tobytes() for ids in word_ids(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed, pa.binary()), batch.column(1), batch.column(2)], ["ids", "toxic", "place"])

    collected = sorted(first.mapInArrow(ids, "ids binary, toxic int, place long").collect(), key=lambda r: (r.place, r.ids))
    model = train([np.frombuffer(r.ids, np.int32).reshape(-1, PARTS) for r in collected],
                  np.array([r.toxic for r in collected], np.float32))
    del collected
    model = refine(model, learn, sum(learned.values()))
    counted = _histogram(rows.filter(known), model) if learn is not rows else []
    # The model itself learns from all rows.
    model = refine(model, rows, sum(every.values()))
    model.squares = {}
    odds, langs, toxic, times = (np.array([row[name] for row in counted]) for name in ("step", "lang", "toxic", "n"))
    scores = 1 / (1 + np.exp(-odds / ODDS))
    # One shift for all languages puts the best common threshold at 0.5.
    common = best_threshold(scores, toxic, times)
    shift = np.log(common / (1 - common))
    model.shift = np.float32(model.shift - shift)
    scores = 1 / (1 + np.exp(shift - odds / ODDS))
    return model, {
        str(lang): best_threshold(scores[langs == lang], toxic[langs == lang], times[langs == lang])
        for lang in sorted(set(langs))}


def _scored(docs: DataFrame, labels: DataFrame, sample: int, folds: int) -> tuple[DataFrame, dict[str, str]]:
    model, thresholds = fit(docs, labels, sample, folds)
    shared = docs.sparkSession.sparkContext.broadcast((model, thresholds))
    rows, names = masked(docs)
    kept = rows.columns
    rows = rows.select("*", F.col(names["text"]).alias("_text"), F.col(names["lang"]).cast("string").alias("_lang"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, thresholds = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = model.scores(word_ids(part.column(len(kept)).to_pylist()))
                limits = np.array([thresholds.get(lang or "", 0.5) for lang in part.column(len(kept) + 1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(values), pa.array((values >= 0.5).astype(np.int32)),
                     pa.array(values >= limits)], [*kept, "score", "predicted", "flagged"])

    schema = T.StructType([f for f in rows.schema.fields if f.name in kept])
    schema = schema.add("score", T.DoubleType()).add("predicted", T.IntegerType()).add("flagged", T.BooleanType())
    return rows.mapInArrow(score, schema), names


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> DataFrame:
    """Every row of `docs` as `doc_id`, `score`, `predicted` (score of 0.5 or more) and `flagged`.

    `flagged` compares the score with the threshold of the row's `lang`. The score
    itself depends on the text alone. NULL and empty texts get the score of a
    text without words. Labels of unknown ids and NULL labels are not used;
    of repeated labels the larger one counts. No rows give no rows.
    """
    scored, names = _scored(docs.select("doc_id", "text", "lang"), labels, sample, folds)
    return scored.select(F.col(names["doc_id"]).alias("doc_id"), "score", "predicted", "flagged")


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> DataFrame:
    """The rows of `docs` with a score below the threshold of their `lang`, with all their columns."""
    scored, names = _scored(docs, labels, sample, folds)
    return unmasked(scored.filter("NOT flagged"), names)
