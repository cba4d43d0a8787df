"""Substring dedup by super-k-mers.

A window is `WINDOW` consecutive words. Its minimiser is the run of `MER` words in it
with the least hash, the leftmost of equal ones. Consecutive windows with the
same minimiser at the same place travel together, as one string of packed
words, to the bucket of that minimiser, where sorting counts windows exactly. Equal windows
have equal minimisers, so they meet.

1. Minimisers are counted without their strings. A window that repeats has a
   minimiser that repeats; a bitmap of fixed size keeps the strings of most others at
   home. When it fills up, more strings travel, with the same result.
2. A table of fixed size holds the order of magnitude of the counts. Buckets of many strings
   are split by document. Each part reports its windows once, and windows seen
   once in a part are settled by a second count, of one row per part.
3. Covered words come back as intervals per document, which is joined with its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import staged

WINDOW = 35
MER = 8
# Bytes of a packed word.
PACKED = 5
BITS = 28
LEVEL_BITS = 18
# Strings of a minimiser that one task takes, as a power of two.
BUCKET_LEVEL = 9
PLACE_BITS = 20
PIECE = 1 << 19
# Words that a task sorts at once, if its buckets allow it.
SORTED = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MASK = np.uint64((1 << (8 * PACKED)) - 1)
ROW = ("_null", "_id", "_text")


def _identified(docs: DataFrame):
    return docs.select(
        F.col("doc_id").isNull().alias("_null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_text"), F.col("text").cast("binary").alias("_bytes"))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and the number of words of each text."""
    digest = xxhash.xxh64_intdigest
    words = [(text or b"").split() for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    return np.array([digest(word) for w in words for word in w], np.uint64), lengths


def _super_mers(hashes: np.ndarray, lengths: np.ndarray, window: int, mer: int):
    """Runs of windows with one minimiser: its hash, first window, last window, text. Places are global."""
    found = []
    ends = np.repeat(np.cumsum(lengths), lengths)
    texts = np.repeat(np.arange(len(lengths)), lengths)
    reach = window - mer + 1
    for at in range(0, len(hashes), PIECE):
        part = hashes[at:at + PIECE + window - 1]
        count = len(part) - window + 1
        if count <= 0:
            continue
        grams = np.zeros(len(part) - mer + 1, np.uint64)
        for j in range(mer):
            grams *= BASE
            grams += part[j:j + len(grams)]
        grams = _mixed(grams)
        # Hash above, place below: the least is the leftmost minimiser.
        least = (grams << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size * 2 <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < reach:
            least = np.minimum(least[:len(least) - (reach - size)], least[reach - size:])
        least = least[:count]
        valid = np.arange(at, at + count) + window <= ends[at:at + count]
        owner = texts[at:at + count]
        new = np.ones(count, bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        # Windows that cross into the next text are the last ones of theirs.
        firsts = np.flatnonzero(new & valid)
        stops = np.append(np.flatnonzero(new | ~valid), count)
        lasts = stops[np.searchsorted(stops, firsts, "right")] - 1
        places = (least[firsts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        found.append((grams[places], firsts + at, lasts + at, owner[firsts]))
    if not found:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _counted(rows: DataFrame, window: int, mer: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                minimisers = _super_mers(*_word_hashes(batch.column(0).slice(at, 256).to_pylist()), window, mer)[0]
                values, counts = np.unique(minimisers, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["m", "n"])

    counts = rows.select("_bytes").mapInArrow(count, "m long, n long")
    return counts.groupBy("m").agg(F.sum("n").alias("n")).filter("n > 1")


def _tables(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap of the minimisers that repeat, and orders of magnitude of their counts; both of fixed size."""
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    place = f"shiftrightunsigned(m, {64 - BITS})"
    maps = counts.groupBy(F.expr(f"{place} div 32768").alias("part")).agg(
        F.bitmap_construct_agg(F.expr(f"{place} % 32768")).alias("map"))
    for part, data in maps.toLocalIterator():
        bits[part * 4096:(part + 1) * 4096] = np.frombuffer(data, np.uint8)
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    sums = counts.groupBy(F.expr(f"pmod(m, {1 << LEVEL_BITS})").alias("slot")).agg(F.max("n").alias("n")).filter(
        f"n > {1 << BUCKET_LEVEL}").selectExpr("slot", "CAST(ceil(log2(n)) AS int) AS level")
    for slot, level in sums.toLocalIterator():
        levels[slot] = level
    return bits, levels


def _parts(m: np.ndarray, levels: np.ndarray) -> np.ndarray:
    level = levels[(m & np.uint64((1 << LEVEL_BITS) - 1)).astype(np.int64)].astype(np.int64)
    return np.left_shift(1, np.maximum(level - BUCKET_LEVEL, 0))


def _sent(rows: DataFrame, tables, window: int, mer: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, levels = tables.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes, lengths = _word_hashes(part.column(3).to_pylist())
                m, first, last, owner = _super_mers(hashes, lengths, window, mer)
                place = (m >> np.uint64(64 - BITS)).astype(np.int64)
                # Spark's bitmaps count bits from the lowest.
                kept = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                m, first, last, owner = m[kept], first[kept], last[kept], owner[kept]
                begins = np.cumsum(lengths) - lengths
                packed = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :PACKED]).tobytes()
                strings = [packed[PACKED * s:PACKED * e] for s, e in zip(first.tolist(), (last + window).tolist())]
                ids = part.column(1).to_numpy()[owner]
                texts = part.column(2).to_numpy()[owner]
                split = _parts(m, levels)
                salts = np.where(split > 1, 1 + _mixed(ids.view(np.uint64) ^ texts.view(np.uint64)).astype(np.int64) % split, 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(m.view(np.int64)), pa.array(np.abs(salts)), part.column(0).take(pa.array(owner)), pa.array(ids),
                    pa.array(texts), pa.array((first - begins[owner]).astype(np.int32)), pa.array(strings, pa.binary()),
                ], ["m", "salt", "_null", "_id", "_text", "start", "words"])

    return rows.mapInArrow(
        send, "m long, salt long, _null boolean, _id long, _text long, start int, words binary")


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of some runs of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _settle(table: pa.Table, window: int) -> pa.RecordBatch:
    """Windows of whole buckets: runs that repeat as intervals, and what a split bucket leaves open."""
    strings = table.column("words").to_pylist()
    lengths = np.array([len(s) // PACKED for s in strings], np.int64)
    raw = np.zeros((lengths.sum(), 8), np.uint8)
    raw[:, :PACKED] = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, PACKED)
    words = raw.view(np.uint64).reshape(-1)
    begins = np.cumsum(lengths) - lengths
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(strings)), counts)
    inside = _spread(counts)
    place = begins[owner] + inside
    # A prefix of powers gives the hash of any window.
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), BASE)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), BACK)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(words) * power[:-1])])
    hashes = _mixed((total[place + window] - total[place]) * back[place])
    salt = table.column("salt").to_numpy()
    # Windows of different parts of a split bucket are not compared.
    order = np.lexsort((salt[owner], hashes))
    h, s, p = hashes[order], salt[owner][order], place[order]
    same = (h[1:] == h[:-1]) & (s[1:] == s[:-1])
    left, right = p[:-1][same], p[1:][same]
    equal = np.ones(len(left), bool)
    for k in range(window):
        equal &= words[left + k] == words[right + k]
    if not equal.all():
        # Different windows with one hash: their words decide.
        order = np.array(sorted(range(len(place)), key=lambda i: (
            salt[owner[i]], hashes[i], words[place[i]:place[i] + window].tobytes())), np.int64)
        p = place[order]
        same = np.array([
            salt[owner[a]] == salt[owner[b]] and (words[place[a]:place[a] + window] == words[place[b]:place[b] + window]).all()
            for a, b in zip(order[:-1], order[1:])], bool)
    repeated = np.zeros(len(place), bool)
    repeated[order[1:]] |= same
    repeated[order[:-1]] |= same
    lead = np.ones(len(place), bool)
    lead[order[1:]] = ~same

    start = table.column("start").to_numpy().astype(np.int64)[owner] + inside
    run = repeated.copy()
    run[1:] &= ~(repeated[:-1] & (owner[1:] == owner[:-1]))
    ends = repeated.copy()
    ends[:-1] &= ~(repeated[1:] & (owner[1:] == owner[:-1]))
    a, b = np.flatnonzero(run), np.flatnonzero(ends)
    # One row for each window that a part has seen, for the second count.
    open_ = np.flatnonzero(lead & (salt[owner] > 0))
    rows = np.concatenate([owner[a], owner[open_]])
    columns = [table.column(name).combine_chunks().take(pa.array(rows)) for name in ROW]
    first = np.concatenate([start[a], start[open_]]).astype(np.int32)
    last = np.concatenate([start[b], start[open_]]).astype(np.int32) + np.int32(window)
    seen = np.concatenate([np.zeros(len(a), np.int64), 1 + repeated[open_]]).astype(np.int32)
    digests = np.zeros((len(rows), 2), np.uint64)
    for k, i in enumerate(open_.tolist(), len(a)):
        digests[k] = np.frombuffer(xxhash.xxh128_digest(words[place[i]:place[i] + window].tobytes()), np.uint64)
    signed = digests.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(first), pa.array(last), pa.array(seen), pa.array(signed[:, 0]), pa.array(signed[:, 1])],
        [*ROW, "start", "stop", "seen", "h1", "h2"])


def _bucket_walk(window: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, last = [], 0, None
        for batch in batches:
            m = batch.column(0).to_numpy()
            salt = batch.column(1).to_numpy()
            at = 0
            edges = np.flatnonzero((m[1:] != m[:-1]) | (salt[1:] != salt[:-1])) + 1
            if last is not None and batch.num_rows and (m[0], salt[0]) != last:
                edges = np.append([0], edges)
            if size >= SORTED and len(edges):
                if edges[0]:
                    waiting.append(batch.slice(0, int(edges[0])))
                yield _settle(pa.Table.from_batches(waiting), window)
                waiting, size, at = [], 0, int(edges[0])
            rest = batch.slice(at)
            if rest.num_rows:
                waiting.append(rest)
                size += rest.column("words").nbytes // PACKED
                last = (m[-1], salt[-1])
        if waiting:
            yield _settle(pa.Table.from_batches(waiting), window)
    return walk


def repeated_spans(docs: DataFrame, window: int = WINDOW, mer: int = MER) -> DataFrame:
    """Word intervals (`start`, `stop`) that repeated windows cover, by (`_null`, `_id`, `_text`); they may overlap."""
    rows = _identified(docs)
    tables = docs.sparkSession.sparkContext.broadcast(_tables(staged(_counted(rows, window, mer), "minimisers")))
    sent = _sent(rows, tables, window, mer).repartition("m", "salt").sortWithinPartitions("m", "salt")
    schema = "_null boolean, _id long, _text long, start int, stop int, seen int, h1 long, h2 long"
    found = staged(sent.mapInArrow(_bucket_walk(window), schema), "repeated-windows")
    # Of each part of a split bucket a window has one row here.
    total = found.filter("seen > 0").selectExpr("*", "sum(seen) OVER (PARTITION BY h1, h2) AS total")
    later = total.filter("seen = 1 AND total > 1")
    names = [*ROW, "start", "stop"]
    return found.filter("seen = 0").select(*names).unionByName(later.select(*names))


def deduplicated(docs: DataFrame, window: int = WINDOW, mer: int = MER) -> DataFrame:
    """Every row as `doc_id`, `kept_text` (words joined by one space), `n_words` before, `n_removed`.

    A word goes if it is in a window whose words also start elsewhere, in the same
    text or another; windows are judged on the input. Words are compared as they
    are. Repeated rows repeat each other's windows. NULL and empty texts have no words; texts
    shorter than a window lose none.
    """
    spans = repeated_spans(docs, window, mer).groupBy(*ROW).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("_spans"))
    joined = _identified(docs).join(spans, list(ROW), "left").select(
        F.when(~F.col("_null"), F.col("_id")).alias("doc_id"), "_bytes",
        F.col("_spans.start").alias("_starts"), F.col("_spans.stop").alias("_stops"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, before, removed = [], [], []
                for text, starts, stops in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    words = (text or b"").split()
                    before.append(len(words))
                    if starts:
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, starts, 1)
                        np.add.at(change, stops, -1)
                        keep = np.cumsum(change[:-1]) == 0
                        words = [word for word, kept in zip(words, keep.tolist()) if kept]
                    removed.append(before[-1] - len(words))
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()),
                    pa.array(removed, pa.int64())], ["doc_id", "kept_text", "n_words", "n_removed"])

    return joined.mapInArrow(remove, "doc_id long, kept_text string, n_words long, n_removed long")
