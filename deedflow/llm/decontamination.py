"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping windows. If a window of `w` characters
lies in a document with at most `e` edits, the two share at least
`w - q + 1 - q * e` q-grams whose diagonals (place in the document less place
in the window) differ by `e` at most. Diagonals are counted in overlapping bands of
width `2 e`; bands that reach the bound are verified by a banded alignment.

The benchmark is a stated query set. It is taken in blocks of `BLOCK` windows, each
broadcast and held against all documents, whole texts, inside Arrow batches. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 80
STEP = 40
QGRAM = 12
# Edits for each character of a window.
EDITS = 0.05
BLOCK = 10_000
# Characters that are hashed at once.
PIECE = 1 << 18
FILTER_BITS = 20
# Characters between texts that are hashed together; more than any budget of edits.
GAP = 64
ROWS = 256
BASE = np.uint64(0x9E3779B97F4A7C15)
NOTHING = np.uint32(0xFFFFFFFF)


def normalised(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(values: np.ndarray, q: int = QGRAM) -> np.ndarray:
    """A hash of the q-gram at each place."""
    count = max(len(values) - q + 1, 0)
    wide = values.astype(np.uint64)
    out = np.zeros(count, np.uint64)
    for j in range(q):
        out *= BASE
        out += wide[j:j + count]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


class Block:
    """Windows of some benchmark items, with their q-grams sorted by hash."""

    def __init__(self, items: list[tuple[int, str]], window=WINDOW, step=STEP, q=QGRAM, edits=EDITS):
        self.q, self.items, self.windows, self.places = q, [], [], []
        hashes, owners, offsets = [], [], []
        for item, text in items:
            values = codes(text)
            last = max(len(values) - window, 0)
            for start in sorted({*range(0, last, step), last}):
                part = values[start:start + window]
                grams = gram_hashes(part, q)
                hashes.append(grams)
                owners.append(np.full(len(grams), len(self.items), np.int64))
                offsets.append(np.arange(len(grams)))
                self.items.append(item)
                self.windows.append(part)
        hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owners = np.concatenate([np.zeros(0, np.int64), *owners])[order]
        self.offsets = np.concatenate([np.zeros(0, np.int64), *offsets])[order]
        self.lengths = np.array([len(part) for part in self.windows], np.int64)
        # The lemma must leave at least one q-gram.
        self.edits = np.minimum((self.lengths * edits).astype(np.int64), np.maximum((self.lengths - q) // q, 0))
        self.bounds = self.lengths - q + 1 - q * self.edits
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.hashes)] = True
        self.padded = np.full((len(self.windows), max([*self.lengths, 1])), NOTHING, np.uint32)
        for k, part in enumerate(self.windows):
            self.padded[k, :len(part)] = part

    @staticmethod
    def _slot(hashes):
        return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def hits(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and diagonal of every q-gram that `values` shares with a window."""
        windows, diagonals = [], []
        for at in range(0, len(values), PIECE):
            hashes = gram_hashes(values[at:at + PIECE + self.q - 1], self.q)
            places = np.flatnonzero(self.filter[self._slot(hashes)])
            low = np.searchsorted(self.hashes, hashes[places], "left")
            counts = np.searchsorted(self.hashes, hashes[places], "right") - low
            entries = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            windows.append(self.owners[entries])
            diagonals.append(np.repeat(places + at, counts) - self.offsets[entries])
        return np.concatenate([np.zeros(0, np.int64), *windows]), np.concatenate([np.zeros(0, np.int64), *diagonals])

    def candidates(self, windows: np.ndarray, diagonals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and first diagonal of the bands that reach the lemma's bound."""
        step = np.maximum(self.edits[windows], 1)
        band = diagonals // step
        # A diagonal is in the band that starts at its step and in the one before.
        owners = np.concatenate([windows, windows])
        bands = np.concatenate([band, band - 1])
        order = np.lexsort((bands, owners))
        owners, bands = owners[order], bands[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(owners) != 0) | (np.diff(bands) != 0)])) if len(owners) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(owners)))
        kept = new[counts >= self.bounds[owners[new]]]
        return owners[kept], bands[kept] * np.maximum(self.edits[owners[kept]], 1)

    def distances(self, values: np.ndarray, windows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Edit distance of each window to its best place within its band and `e` diagonals around it."""
        out = np.zeros(len(windows), np.int64)
        for at in range(0, len(windows), 2048):
            w, first = windows[at:at + 2048], firsts[at:at + 2048]
            edits, lengths = self.edits[w], self.lengths[w]
            width = int(4 * max(edits.max(), 1) + 1)
            start = first - np.maximum(edits, 1)
            slots = np.arange(width)
            row = np.zeros((len(w), width), np.int64)
            best = np.zeros(len(w), np.int64)
            for i in range(int(lengths.max())):
                places = start[:, None] + i + slots
                inside = (places >= 0) & (places < len(values))
                seen = np.where(inside, values[np.clip(places, 0, max(len(values) - 1, 0))], NOTHING - np.uint32(1))
                moved = np.concatenate([row[:, 1:], np.full((len(w), 1), 1 << 20)], axis=1) + 1
                row = np.minimum(row + (seen != self.padded[w, i][:, None]), moved)
                row = np.minimum.accumulate(row - slots, axis=1) + slots
                done = lengths == i + 1
                best[done] = row[done].min(1)
            out[at:at + 2048] = best
        return out

    def leaks(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """Items found in each text: windows, least edits, first place in the normalised text."""
        out: list[dict[int, list]] = [{} for _ in texts]
        gap = np.full(GAP, NOTHING, np.uint32)
        parts = [codes(normalised(text)) for text in texts]
        at = 0
        while at < len(parts):
            to, size = at, 0
            while to < len(parts) and (to == at or size + len(parts[to]) <= PIECE):
                size += len(parts[to]) + GAP
                to += 1
            values = np.concatenate([x for part in parts[at:to] for x in (part, gap)])
            starts = np.cumsum([0] + [len(part) + GAP for part in parts[at:to - 1]])
            windows, firsts = self.candidates(*self.hits(values))
            if len(windows):
                edits = self.distances(values, windows, firsts)
                kept = edits <= self.edits[windows]
                windows, firsts, edits = windows[kept], firsts[kept], edits[kept]
                owners = np.searchsorted(starts, firsts + self.lengths[windows] // 2, "right") - 1
                places = np.maximum(firsts - starts[owners], 0)
                for k, w, e, p in zip(owners.tolist(), windows.tolist(), edits.tolist(), places.tolist()):
                    out[at + k].setdefault(self.items[w], []).append((w, e, p))
            at = to
        return [
            {i: (len({w for w, _, _ in f}), min(e for _, e, _ in f), min(p for _, _, p in f)) for i, f in found.items()}
            for found in out
        ]


def blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[Block]:
    """The benchmark in blocks of about `size` windows, one at a time on the driver.

    NULL texts and texts of fewer characters than a q-gram cannot be told from
    chance and are not searched for.
    """
    waiting, count = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        text = normalised(text)
        if len(text) >= QGRAM:
            waiting.append((item, text))
            count += 1 + max(len(text) - WINDOW, 0) // STEP
        if count >= size:
            yield Block(waiting)
            waiting, count = [], 0
    if waiting:
        yield Block(waiting)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of `docs` and item found in it: `doc_id`, `item_id`, `windows`, `edits`, `position`.

    Repeated and NULL ids are reported as they are; NULL and empty texts hold nothing.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, windows int, edits int, position long"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, answers = [], []
                for at in range(0, batch.num_rows, ROWS):
                    for k, found in enumerate(shared.value.leaks(batch.column(1).slice(at, ROWS).to_pylist()), at):
                        rows.extend([k] * len(found))
                        answers.extend((item, *answer) for item, answer in found.items())
                columns = list(zip(*answers)) if answers else [[]] * 4
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                    ["doc_id", "item_id", "windows", "edits", "position"])

        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(search, schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all their columns."""
    names = docs.columns
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    found = shared.value.leaks(batch.column(names.index("text")).to_pylist())
                    yield batch.filter(pa.array([not items for items in found], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
