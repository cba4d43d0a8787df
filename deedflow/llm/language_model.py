"""Scores under an n-gram model that is kept in Elias-Fano tries.

The model counts words with up to two words before them. All orders enter one
mixture, for a word w after a, b:

    P(w | a, b) = (T n(a, b, w) + n(b, w) + L(b) U(w)) / (T n(a, b) + n(b) + L(b))

U is the smoothed share of w among all tokens and L(b) a mass that grows with how
frequent b is, read from a table of fixed size. The numerator needs counts of n-grams that end in
w, and the denominator of the step after w needs counts of contexts that end in w. So
everything about a word lies in one shard, and a text's score is a sum over shards:
documents send their n-grams once, and every shard returns one number per document.

A shard's trie goes from a word to the words before it. Its levels are sorted
sequences in Elias-Fano form with monotone pointers, and log-probabilities in steps of
1 / `STEPS`, in one memory-mapped scratch file that is unlinked when made. A child on the third level is
known by its rank among all words seen before the word in the middle. Queries are sorted and find
their successors block by block.

The number of shards grows with the corpus, so that a shard has about `SHARD`
n-grams. Words with more than `SPLIT` occurrences are split by the word before
them; all their parts get the exact count of the word.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import staged

FOLDS = 10
ADDED = 0.1
TRIGRAM = 30.0
MASS, POWER = 8.0, 0.8
STEPS = 1024
CHUNK = 3 << 19
SHARD = 1 << 20
SPLIT = 17
SLOT_BITS = 22
CONTEXT = np.uint64((1 << 40) - 1)
END = np.uint64(xxhash.xxh64_intdigest(b" end"))
START = np.uint64(xxhash.xxh64_intdigest(b" start"))
BLOCK = 1 << 15


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, an end after each, and the number of each."""
    split = [(text or b"").lower().split() for text in texts]
    place: dict[bytes, int] = {}
    for words in split:
        place.update(dict.fromkeys(words))
    digest = xxhash.xxh64_intdigest
    known = np.array([digest(word) for word in place] + [int(END)], np.uint64)
    for k, word in enumerate(place):
        place[word] = k
    lengths = np.array([len(words) + 1 for words in split], np.int64)
    get, end = place.__getitem__, len(place)
    parts = []
    for words in split:
        ids = np.empty(len(words) + 1, np.int64)
        ids[:-1] = np.fromiter(map(get, words), np.int64, len(words))
        ids[-1] = end
        parts.append(ids)
    return known[np.concatenate([np.zeros(0, np.int64), *parts])], lengths


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, and which places of it begin a new key.

    Numbers are sorted many times faster than places, so keys are sorted with their place in their last bits.
    """
    keys = keys.astype(np.uint64)
    bits = max(len(keys) - 1, 1).bit_length()
    spread = keys << np.uint64(64 - max(int(keys.max(initial=0)).bit_length(), 1))
    mask = np.uint64((1 << bits) - 1)
    order = (np.sort((spread & ~mask) | np.arange(len(keys), dtype=np.uint64)) & mask).astype(np.int64)
    found = keys[order]
    if (found[1:] < found[:-1]).any():
        # Different keys that only their last bits tell apart.
        order = np.argsort(keys)
        found = keys[order]
    return order, np.append(np.ones(min(len(keys), 1), bool), found[1:] != found[:-1])


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and for each key its place among them."""
    order, new = _ordered(keys)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return keys[order[new]], inverse


# -- Elias-Fano levels -------------------------------------------------------


class Scratch:
    """Arrays in a file that only this task sees, mapped into memory once all are written."""

    def __init__(self):
        self.file, self.size, self.map = tempfile.TemporaryFile(), 0, None

    def put(self, array: np.ndarray) -> tuple:
        data = np.ascontiguousarray(array)
        spot = (self.size, data.dtype, len(data))
        padding = -data.nbytes % 8
        self.file.write(data.tobytes() + bytes(padding))
        self.size += data.nbytes + padding
        return spot

    def close(self):
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ) if self.size else b""
        self.file.close()

    def get(self, spot: tuple) -> np.ndarray:
        at, kind, count = spot
        return np.frombuffer(self.map, kind, count, at) if count else np.zeros(0, kind)


class Sequence:
    """A sorted sequence: low bits packed, high bits as steps of a bitmap.

    A directory holds, for every `BLOCK` values, the first value and its place in the bitmap.
    """

    def __init__(self, scratch: Scratch, values: np.ndarray):
        values = values.astype(np.uint64)
        self.scratch, self.count = scratch, len(values)
        top = int(values[-1]) if len(values) else 0
        self.low = max(0, (top // max(len(values), 1)).bit_length() - 1)
        weights = np.arange(self.low, dtype=np.uint64)
        lows = [
            np.packbits(((values[at:at + BLOCK, None] >> weights) & np.uint64(1)).astype(np.uint8), bitorder="little")
            for at in range(0, len(values), BLOCK)
        ]
        places = (values >> np.uint64(self.low)).astype(np.int64) + np.arange(len(values))
        bitmap = np.zeros(int(places[-1]) + 1 if len(values) else 0, np.uint8)
        bitmap[places] = 1
        self.lows = scratch.put(np.concatenate([np.zeros(0, np.uint8), *lows]))
        self.highs = scratch.put(np.packbits(bitmap, bitorder="little"))
        self.firsts = scratch.put(values[::BLOCK])
        self.starts = scratch.put(places[::BLOCK])

    def block(self, number: int) -> np.ndarray:
        """Values of one block."""
        at, count = number * BLOCK, min(BLOCK, self.count - number * BLOCK)
        starts, highs = self.scratch.get(self.starts), self.scratch.get(self.highs)
        start = int(starts[number])
        stop = int(starts[number + 1]) if number + 1 < len(starts) else 8 * len(highs)
        bits = np.unpackbits(highs[start // 8:-(-stop // 8)], bitorder="little")
        ones = np.flatnonzero(bits[start % 8:][:stop - start])[:count] + start
        high = (ones - at - np.arange(count)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        lows = self.scratch.get(self.lows)[at * self.low // 8:]
        bits = np.unpackbits(lows[:-(-count * self.low // 8)], count=count * self.low, bitorder="little")
        packed = np.zeros((count, 64), np.uint8)
        packed[:, :self.low] = bits.reshape(count, self.low)
        return high | np.packbits(packed, axis=1, bitorder="little").view(np.uint64).reshape(-1)

    def values(self) -> np.ndarray:
        blocks = -(-self.count // BLOCK)
        return np.concatenate([np.zeros(0, np.uint64), *[self.block(k) for k in range(blocks)]])

    def find(self, queries: np.ndarray) -> np.ndarray:
        """Place of each of some sorted queries, -1 where it is absent: its successor is another value."""
        queries = queries.astype(np.uint64)
        out = np.full(len(queries), -1, np.int64)
        if not self.count or not len(queries):
            return out
        firsts = self.scratch.get(self.firsts)
        edges = np.append(np.searchsorted(queries, firsts, "left"), len(queries))
        for number in range(len(firsts)):
            wanted = queries[edges[number]:edges[number + 1]]
            if len(wanted):
                values = self.block(number)
                at = np.minimum(np.searchsorted(values, wanted, "left"), len(values) - 1)
                out[edges[number]:edges[number + 1]] = np.where(values[at] == wanted, at + number * BLOCK, -1)
        return out


def _found(sequence: Sequence, queries: np.ndarray) -> np.ndarray:
    """`find` for queries in any order."""
    unique, inverse = _unique(queries)
    return sequence.find(unique)[inverse]


def _quantised(values: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(values) * STEPS).astype(np.int16)


class Trie:
    """The n-grams of one shard: word, the word before it, the word before that.

    `w`, `b`, `a` are distinct n-grams, `n` their counts in training;
    `counts` the exact counts of words. `share` is U and `mass` L.
    """

    def __init__(self, w, b, a, n, counts: tuple[np.ndarray, np.ndarray], share, mass):
        scratch = Scratch()
        self.scratch, self.share, self.mass = scratch, share, mass
        seen = n > 0
        w, b, a, n = w[seen], b[seen], a[seen], n[seen]
        words = counts[0]
        contexts, places = _unique(np.concatenate([b, a]))
        bi, ai = places[:len(b)], places[len(b):]
        unique, inverse = _unique(w)
        wi = np.searchsorted(words, unique)[inverse]
        size = max(len(contexts), 1)
        # Words seen before each context, for ranks.
        lists, at = _unique(bi * size + ai)
        begins = np.searchsorted(lists, np.arange(size + 1) * size)
        rank = at - begins[bi]
        self.reach = int(np.diff(begins).max(initial=0)) + 1
        pairs, node = _unique(wi * size + bi)
        n2 = np.bincount(node, n, len(pairs))
        children = node * self.reach + rank
        order = _ordered(children)[0]
        children = children[order]
        unigram = share(counts[1])
        pw, pb = pairs // size, pairs % size
        spread = mass(contexts[pb]) * unigram[pw] if len(pairs) else np.zeros(0)
        under2 = counts[1][pw] + mass(words[pw]) + TRIGRAM * n2 if len(pairs) else np.ones(0)
        self.size = size
        self.words, self.contexts = Sequence(scratch, words), Sequence(scratch, contexts)
        self.lists, self.begins = Sequence(scratch, lists), Sequence(scratch, begins)
        self.pairs = Sequence(scratch, pairs)
        self.pair_starts = Sequence(scratch, np.searchsorted(pairs, np.arange(len(words) + 1) * size))
        self.children = Sequence(scratch, children)
        self.child_starts = Sequence(scratch, np.searchsorted(children, np.arange(len(pairs) + 1) * self.reach))
        self.counts = scratch.put(counts[1].astype(np.int64))
        self.over1, self.under1 = (scratch.put(_quantised(x)) for x in (unigram, counts[1] + mass(words)))
        self.over2, self.under2 = (scratch.put(_quantised(x)) for x in (n2 + spread, under2))
        self.over3 = scratch.put(_quantised((TRIGRAM * n + (n2 + spread)[node])[order]))
        scratch.close()

    def score(self, w: np.ndarray, b: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For n-grams: log-probability parts in steps (numerator less the next denominator), count of the word."""
        get = self.scratch.get
        wi, bi, ai = _found(self.words, w), _found(self.contexts, b), _found(self.contexts, a)
        known = wi >= 0
        counts = np.where(known, get(self.counts)[np.maximum(wi, 0)] if self.words.count else 0, 0)
        over = np.where(known, self._at(self.over1, wi), _quantised(self.share(np.zeros(1)))[0]).astype(np.int64)
        over += _quantised(self.mass(b))
        under = np.where(known, self._at(self.under1, wi), _quantised(self.mass(w))).astype(np.int64)
        pair = np.full(len(w), -1, np.int64)
        both = np.flatnonzero(known & (bi >= 0))
        pair[both] = _found(self.pairs, wi[both] * self.size + bi[both])
        # A pair lies among the children of its word.
        starts = self.pair_starts.values().astype(np.int64)
        inside = both[pair[both] >= 0]
        pair[inside[(pair[inside] < starts[wi[inside]]) | (pair[inside] >= starts[wi[inside] + 1])]] = -1
        seen = pair >= 0
        over = np.where(seen, self._at(self.over2, pair), over)
        under = np.where(seen, self._at(self.under2, pair), under)
        third = np.flatnonzero(seen & (ai >= 0))
        # The rank of a word among those before its context is its name on the third level.
        place = _found(self.lists, bi[third] * self.size + ai[third])
        listed = place >= 0
        third, place = third[listed], place[listed]
        rank = place - self.begins.values().astype(np.int64)[bi[third]]
        child = _found(self.children, pair[third] * self.reach + rank)
        starts = self.child_starts.values().astype(np.int64)
        hit = (child >= 0) & (child >= starts[pair[third]]) & (child < starts[pair[third] + 1])
        over[third[hit]] = get(self.over3)[child[hit]]
        return over - np.where(w == END, 0, under), counts

    def _at(self, spot, places):
        values = self.scratch.get(spot)
        return values[np.maximum(places, 0)] if len(values) else np.zeros(len(places), np.int16)


# -- model statistics --------------------------------------------------------


def _merged(values: list[np.ndarray], counts: list[np.ndarray]):
    unique, inverse = _unique(np.concatenate(values))
    return unique, np.bincount(inverse, np.concatenate(counts), len(unique)).astype(np.int64)


def _vocabulary(rows: DataFrame) -> DataFrame:
    """Count of every token of the training rows, as hash `h` and `n`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                v, c = np.unique(tokens(batch.column(0).slice(at, 256).to_pylist())[0], return_counts=True)
                values.append(v)
                counts.append(c)
                size += len(v)
                if size > CHUNK:
                    v, c = _merged(values, counts)
                    values, counts, size = [v], [c], len(v)
                    if size > CHUNK // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(c)], ["h", "n"])
                        values, counts, size = [], [], 0
        if values:
            v, c = _merged(values, counts)
            yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(c)], ["h", "n"])

    counted = rows.filter("NOT held_out").select("_bytes").mapInArrow(count, "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n"))


def _levels(vocabulary: DataFrame) -> np.ndarray:
    """For each slot of a table of fixed size, four times the logarithm of its largest count, plus one."""
    part = 4096
    slots = vocabulary.groupBy(F.expr(f"CAST(h & {(1 << SLOT_BITS) - 1} AS int)").alias("slot")).agg(F.max("n").alias("n"))
    packed = slots.selectExpr(
        f"slot div {part} AS part", f"struct(CAST(slot % {part} AS int) AS k, CAST(1 + floor(4 * log2(n)) AS int) AS level) AS s"
    ).groupBy("part").agg(F.collect_list("s").alias("s"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column(1):
                table = np.zeros(part, np.uint8)
                for s in row.as_py():
                    table[s["k"]] = s["level"]
                out.append(table.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["part", "levels"])

    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    for number, data in packed.mapInArrow(pack, "part long, levels binary").toLocalIterator():
        levels[number * part:(number + 1) * part] = np.frombuffer(data, np.uint8)
    return levels


class Settings:
    """What every task knows: table of levels, totals, number of shards."""

    def __init__(self, levels, total: int, kinds: int, texts: int, shards: int):
        self.levels, self.texts, self.shards = levels, texts, shards
        self.whole = total + ADDED * (kinds + 1)
        self.masses = MASS * (1 + np.concatenate([[0.0], 2.0 ** (np.arange(255) / 4)])) ** POWER

    def level(self, hashes):
        return self.levels[(hashes & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)]

    def mass(self, hashes):
        return self.masses[self.level(hashes)]

    def share(self, counts):
        return (counts + ADDED) / self.whole

    def parts(self, words):
        return np.left_shift(np.int64(1), np.maximum(-(-self.level(words).astype(np.int64) // 4) - SPLIT, 0))

    def place(self, words, part):
        return (_mixed(words + _mixed(part.astype(np.uint64))) % np.uint64(self.shards)).astype(np.int64)


# -- blobs -------------------------------------------------------------------

COUNTS, TOKENS, TEXTS = 0, 1, 2


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Integer arrays, each in as few bytes per number as it needs, byte planes compressed."""
    out = []
    for array in arrays:
        array = array.astype(np.uint64)
        width = max(1, (int(array.max(initial=0)).bit_length() + 7) // 8)
        planes = array.view(np.uint8).reshape(-1, 8)[:, :width].T
        data = zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)
        out.append(np.array([len(array), width, len(data)], np.int64).tobytes() + data)
    return b"".join(out)


def _unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        count, width, size = np.frombuffer(data, np.int64, 3, at)
        planes = np.frombuffer(zstandard.decompress(data[at + 24:at + 24 + size]), np.uint8).reshape(width, count)
        full = np.zeros((count, 8), np.uint8)
        full[:, :width] = planes.T
        out.append(full.view(np.uint64).reshape(-1))
        at += 24 + int(size)
    return out


def _rows(kind: int, shards: list[int], chunk: int, blobs: list[bytes]) -> pa.RecordBatch:
    count = len(blobs)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(count, kind, np.int32)), pa.array(np.array(shards, np.int64)),
        pa.array(np.full(count, chunk, np.int64)), pa.array(blobs, pa.binary())], ["kind", "shard", "chunk", "data"])


def _chunk_rows(settings: Settings, chunk: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The n-grams of a chunk of texts, one blob per shard, and one blob about the texts."""
    w = np.concatenate([p[0] for p in parts])
    lengths = np.concatenate([p[1] for p in parts])
    held = np.concatenate([p[2] for p in parts])
    ids = np.concatenate([p[3] for p in parts])
    empty = np.concatenate([p[4] for p in parts])
    parts.clear()
    begins = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    b = np.concatenate([[START], w[:-1]])
    b[begins] = START
    a = np.concatenate([[START], b[:-1]])
    a[begins] = START
    # An n-gram that a text repeats is one record with its number.
    mark = _mixed(w + _mixed(b + _mixed(a + _mixed(doc.astype(np.uint64)))))
    order, new = _ordered(mark)
    first, times = order[new], np.diff(np.flatnonzero(new), append=len(mark))
    del mark, order, new
    w, b, a, doc = w[first], b[first] & CONTEXT, a[first] & CONTEXT, doc[first]
    parts_of = settings.parts(w)
    shard = settings.place(w, (_mixed(b) % parts_of.astype(np.uint64)).astype(np.int64))
    # By shard, then by word, but for its last bits: a word that another one parts is listed twice.
    bits = np.uint64(settings.shards.bit_length())
    order = _ordered((shard.astype(np.uint64) << (np.uint64(64) - bits)) | (w >> bits))[0]
    edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
    shards, blobs = [], []
    for start, stop in zip(edges, [*edges[1:], len(order)]):
        at = order[start:stop]
        words = w[at]
        steps = np.append(False, words[1:] != words[:-1])
        words = words[np.append(0, np.flatnonzero(steps))]
        contexts, ci = _unique(np.concatenate([b[at], a[at]]))
        shards.append(int(shard[at[0]]))
        blobs.append(_packed([
            words, np.diff(contexts, prepend=np.uint64(0)), steps, ci[:len(at)], ci[len(at):],
            doc[at] * 2 + held[doc[at]], times[at]]))
        if len(blobs) == 64:
            yield _rows(TOKENS, shards, chunk, blobs)
            shards, blobs = [], []
    if blobs:
        yield _rows(TOKENS, shards, chunk, blobs)
    texts = _packed([ids.view(np.uint64), empty.astype(np.int64), held.astype(np.int64), lengths])
    yield _rows(TEXTS, [chunk % settings.shards], chunk, [texts])


def _sent(rows: DataFrame, vocabulary: DataFrame, shared) -> DataFrame:
    schema = "kind int, shard long, chunk long, data binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settings, number = shared.value, 0
        base, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes, lengths = tokens(part.column(2).to_pylist())
                ids = part.column(0)
                parts.append((
                    hashes, lengths, part.column(1).to_numpy(zero_copy_only=False).astype(np.int64),
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
                size += len(hashes)
                if size >= CHUNK:
                    yield from _chunk_rows(settings, base + number, parts)
                    number, size = number + 1, 0
        if parts:
            yield from _chunk_rows(settings, base + number, parts)

    def send_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settings = shared.value
        for batch in batches:
            words, counts = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            times = settings.parts(words)
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            words, counts = np.repeat(words, times), np.repeat(counts, times)
            shard = settings.place(words, part)
            order = np.lexsort((words, shard))
            # Parts of a word that lie in one shard share its count.
            order = order[(np.diff(shard[order], prepend=-1) != 0) | (np.diff(words[order], prepend=np.uint64(0)) != 0)]
            edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
            cuts = [order[s:e] for s, e in zip(edges, [*edges[1:], len(order)])]
            yield _rows(COUNTS, [int(shard[c[0]]) for c in cuts], 0, [_packed([words[c], counts[c]]) for c in cuts])

    grams = rows.select("doc_id", "held_out", "_bytes").mapInArrow(send, schema)
    return grams.unionByName(vocabulary.select("h", "n").mapInArrow(send_counts, schema))


def _scored(settings: Settings, counts: list[bytes], blobs: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Parts of the scores of all texts of one shard, one blob per chunk."""
    pairs = [_unpacked(data) for data in counts]
    words, n1 = _merged([p[0] for p in pairs], [p[1] for p in pairs]) if pairs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    columns = []
    for _, data in blobs:
        own, contexts, steps, b, a, doc, times = _unpacked(data)
        contexts = np.cumsum(contexts)
        columns.append((own[np.cumsum(steps.astype(np.int64))], contexts[b.astype(np.int64)], contexts[a.astype(np.int64)],
                        doc.astype(np.int32), times.astype(np.int32)))
    sizes = [len(c[0]) for c in columns]
    w, b, a, doc, times = (np.concatenate(c) for c in zip(*columns))
    columns.clear()
    blobs = [(chunk, None) for chunk, _ in blobs]
    # An n-gram is known by a hash of all its words.
    key = _mixed(w + _mixed(b + _mixed(a)))
    order, new = _ordered(key)
    first = order[new]
    inverse = np.empty(len(key), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    del key, order, new
    w, b, a = w[first], b[first], a[first]
    n = np.bincount(inverse, times * (1 - doc % 2), len(first))
    trie = Trie(w, b, a, n, (words, n1), settings.share, settings.mass)
    steps, known = trie.score(w, b, a)
    del trie, w, b, a, n, first
    base = np.log10(known + ADDED)
    at = 0
    for (chunk, _), size in zip(blobs, sizes):
        k = inverse[at:at + size]
        texts, place = _unique(doc[at:at + size] // 2)
        m = times[at:at + size].astype(np.int64)
        sums = np.stack([np.bincount(place, x, len(texts)) for x in (m * steps[k], m * base[k], m * (known[k] > 0))])
        data = zstandard.compress(texts.astype(np.int32).tobytes() + sums[2].astype(np.int32).tobytes()
                                  + sums[0].astype(np.int64).tobytes() + sums[1].tobytes(), 1)
        yield _rows(TOKENS, [0], chunk, [data])
        at += size


def _shard_walk(shared):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, blobs, current = [], [], None
        for batch in batches:
            for kind, shard, chunk, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if kind == TEXTS:
                    yield _rows(TEXTS, [0], chunk, [data])
                    continue
                if shard != current:
                    if blobs:
                        yield from _scored(shared.value, counts, blobs)
                    counts, blobs, current = [], [], shard
                if kind == COUNTS:
                    counts.append(data)
                else:
                    blobs.append((chunk, data))
        if blobs:
            yield from _scored(shared.value, counts, blobs)
    return walk


def _gathered(shared):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settings, state, current = shared.value, None, None
        start = np.log10(TRIGRAM * settings.texts + settings.texts + settings.mass(np.array([START & CONTEXT]))[0])

        def done():
            ids, empty, held, lengths, score, base, known = state
            return pa.RecordBatch.from_arrays([
                pa.array(ids, mask=empty), pa.array(held), pa.array(lengths), pa.array(known),
                pa.array(base - lengths * np.log10(settings.whole)), pa.array(score / STEPS - start),
            ], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for kind, chunk, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if kind == TEXTS:
                    if state is not None:
                        yield done()
                    ids, empty, held, lengths = _unpacked(data)
                    zero = np.zeros(len(ids))
                    state = (ids.view(np.int64), empty > 0, held > 0, lengths.astype(np.int64),
                             zero.copy(), zero.copy(), np.zeros(len(ids), np.int64))
                else:
                    raw = zstandard.decompress(data)
                    size = len(raw) // 24
                    texts, known = np.frombuffer(raw, np.int32, 2 * size).reshape(2, size)
                    state[4][texts] += np.frombuffer(raw, np.int64, size, 8 * size)
                    state[6][texts] += known
                    state[5][texts] += np.frombuffer(raw, np.float64, size, 16 * size)
        if state is not None:
            yield done()
    return gather


def scores(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Rows are held out if the checksum of their id, written as text, is divisible by `folds`; the model
    learns from all others. A NULL id is never held out. A NULL or empty text is one end. Repeated
    rows count as often as they are there. Without any training row all tokens are
    unknown and equally likely.
    """
    spark = docs.sparkSession
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(mark, F.lit(False)).alias("held_out"),
        F.col("text").cast("binary").alias("_bytes"))
    vocabulary = staged(_vocabulary(rows), "vocabulary")
    end = int(np.array([END]).view(np.int64)[0])
    kinds, total, texts = vocabulary.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("h") == end, F.col("n"))), F.lit(0))
    ).first()
    shards = max(4, -(-total // SHARD))
    shared = spark.sparkContext.broadcast(Settings(_levels(vocabulary), total, kinds, texts, shards))
    sent = _sent(rows, vocabulary, shared).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "chunk")
    parts = sent.mapInArrow(_shard_walk(shared), "kind int, shard long, chunk long, data binary")
    gathered = parts.select("kind", "chunk", "data").repartition("chunk").sortWithinPartitions("chunk", F.desc("kind"))
    scored = gathered.mapInArrow(
        _gathered(shared),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
