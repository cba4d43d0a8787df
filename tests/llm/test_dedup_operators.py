"""Near-dedup, decontamination, line and substring dedup against brute force and SQL."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from compare import connect, differences
from deedflow.llm import components, decontamination, line_dedup, simhash, substring_dedup
from deedflow.llm.queries import ORACLES, QUERIES
from fixtures import documents, empty, prose, rows, words

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    connection = connect(SF_DIR)
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == []


# -- SimHash -----------------------------------------------------------------


def fingerprint(text):
    tokens = [w.lower() for w in words(text)]
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[k:k + 3]) for k in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def smallest_reachable(pairs):
    """Smallest id by fingerprint, over chains of links, for (id, fingerprint) pairs."""
    marks = sorted({f for _, f in pairs})
    parent = {f: f for f in marks}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for k, f in enumerate(marks):
        for g in marks[:k]:
            if (f ^ g).bit_count() <= 2:
                parent[root(f)] = root(g)
    best = {}
    for i, f in pairs:
        if i is not None:
            best[root(f)] = min(best.get(root(f), i), i)
    return {f: best.get(root(f)) for f in marks}


def test_clusters_equal_brute_force(spark):
    found = simhash.clusters(documents(spark)).collect()
    marks = {(d, t): fingerprint(t) for d, t, *_ in rows()}
    expected = smallest_reachable([(d, f) for (d, _), f in marks.items()])
    assert sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in found) == sorted(
        (str(d), fingerprint(t), str(expected[fingerprint(t)])) for d, t, *_ in rows())
    assert simhash.clusters(empty(spark)).count() == 0


def test_index_loses_no_link(spark, monkeypatch):
    # Small leaves give a tree of several levels; near values lie in all of them.
    monkeypatch.setattr(simhash, "LEAF", 4)
    monkeypatch.setattr(simhash, "FAN", 4)
    rng = random.Random(5)
    values = {0, 2**64 - 1, 3}
    for _ in range(120):
        value = rng.getrandbits(64)
        values.add(value)
        for _ in range(rng.randrange(4)):
            value ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(value)
    dense = rng.getrandbits(64)
    values |= {dense ^ k << 20 for k in range(200)}
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    edges = components.components(simhash.links(spark.createDataFrame(signed, "fp long")))
    roots = {r.node: r.root for r in edges.collect()}
    groups = collections.defaultdict(set)
    for v in values:
        s = int(np.uint64(v).astype(np.int64))
        groups[roots.get(s, s)].add(v)
    expected = smallest_reachable([(v, v) for v in values])
    other = collections.defaultdict(set)
    for v in values:
        other[expected[v]].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, other.values()))


def test_one_of_each_keeps_the_smallest_id_once(spark):
    kept = simhash.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    found = [r.doc_id for r in kept.collect()]
    marks = [(d, fingerprint(t)) for d, t, *_ in rows()]
    expected = smallest_reachable(marks)
    named = {i for i in expected.values() if i is not None}
    assert len(found) == len(set(found)) and {i for i in found if i is not None} == named


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(50)] + [(1000, 1000 + k) for k in range(1, 40)] + [(7, 7)]
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {k: 0 for k in range(51)} | {1000 + k: 1000 for k in range(40)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline_keeps_one_of_each_group(spark):
    docs = documents(spark)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    marks = [(i, fingerprint(t)) for i, t, *_ in rows()]
    named = {i for i in smallest_reachable(marks).values() if i is not None}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == named
    assert corpus_pipeline.drop_near_copies(spark, empty(spark), SF_DIR).count() == 0


# -- decontamination ---------------------------------------------------------


def distance(window, text):
    """Edit distance of a window to its best place anywhere in a text."""
    row = [0] * (len(text) + 1)
    for c in window:
        last, row = row, [row[0] + 1]
        for j, t in enumerate(text):
            row.append(min(last[j] + (c != t), last[j + 1] + 1, row[j] + 1))
    return min(row)


def test_leaks_equal_alignment_of_all_windows(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, 30)) for k in range(6)] + [(7, "short"), (8, None), (9, items_text := prose(rng, 12)), (9, items_text)]
    docs = []
    for k in range(24):
        item = (items[k % 6][1] or "")
        for _ in range(rng.choice([0, 1, 2, 4, 9])):
            at = rng.randrange(len(item))
            item = item[:at] + rng.choice(["", "z", item[at] + "q"]) + item[at + 1:]
        docs.append((k, prose(rng, 20) + ("  \n" + item.upper() + " " if k % 4 else " ") + prose(rng, 15)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, items[1][1])]
    data = [(i, t, "en", "a", 0, "x", 0.0, 0, 0) for i, t in docs]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = set()
    for doc_id, text in docs:
        text = decontamination.normalised(text)
        for item, other in items:
            other = decontamination.normalised(other)
            if len(other) >= decontamination.QGRAM:
                last = max(len(other) - decontamination.WINDOW, 0)
                for start in {*range(0, last, decontamination.STEP), last}:
                    window = other[start:start + decontamination.WINDOW]
                    budget = min(int(len(window) * decontamination.EDITS), max((len(window) - 12) // 12, 0))
                    if distance(window, text) <= budget:
                        expected.add((doc_id, item))
    found = decontamination.leaks(documents(spark, data), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    kept = decontamination.clean(documents(spark, data), benchmark)
    assert kept.columns == documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in {d for d, _ in expected})
    assert decontamination.leaks(empty(spark), benchmark).count() == 0
    assert decontamination.clean(documents(spark, data), benchmark.limit(0)).count() == len(data)


def test_blocks_change_nothing(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "benchmark"))
    whole = decontamination.leaks(docs, benchmark).collect()
    single = decontamination.blocks
    monkeypatch.setattr(decontamination, "blocks", lambda b: single(b, 15))
    assert sorted(whole) == sorted(decontamination.leaks(docs, benchmark).collect()) and whole


# -- lines -------------------------------------------------------------------


def test_line_dedup_equals_brute_force(spark):
    data = rows()
    strip = " \t\n\x0b\x0c\r"
    upper = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    keys = [[line.strip(strip).translate(upper) for line in (d[1] or "").split("\n")] for d in data]
    holders = collections.defaultdict(list)
    for d, lines in zip(data, keys):
        for key in set(lines):
            if len(key) >= 40:
                holders[key].append(-1 if d[0] is None else d[0])
    expected = []
    for d, lines in zip(data, keys):
        own = -1 if d[0] is None else d[0]
        keep = [not (len(holders[k]) >= 5 and own != max(holders[k])) if len(k) >= 40 else True for k in lines]
        text = "\n".join(line for line, kept in zip((d[1] or "").split("\n"), keep) if kept)
        expected.append((str(d[0]), text, len(lines), keep.count(False)))
    found = line_dedup.deduplicated(documents(spark)).collect()
    assert sorted((str(r.doc_id), r.kept_text, r.n_lines, r.n_dropped) for r in found) == sorted(expected)
    assert sum(r.n_dropped for r in found) > 5
    assert line_dedup.deduplicated(empty(spark)).count() == 0


# -- substrings --------------------------------------------------------------


@pytest.mark.parametrize("level", [9, 0])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, level):
    # With level 0 every bucket of a repeated minimiser is split.
    monkeypatch.setattr(substring_dedup, "BUCKET_LEVEL", level)
    rng = random.Random(2)
    cycle = " ".join(["x", "y"] * 40)
    data = rows() + [(500 + k, text, "en", "a", 0, "x", 0.0, 0, 0) for k, text in enumerate(
        [cycle, prose(rng, 34), prose(rng, 35), "z " * 36, prose(rng, 10) + " " + cycle])]
    counts = collections.Counter()
    for d in data:
        w = words(d[1])
        counts.update(tuple(w[k:k + 35]) for k in range(len(w) - 34))
    expected = []
    for d in data:
        w = words(d[1])
        gone = set()
        for k in range(len(w) - 34):
            if counts[tuple(w[k:k + 35])] > 1:
                gone.update(range(k, k + 35))
        text = b" ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((str(d[0]), len(w), len(gone), hashlib.sha256(text).hexdigest()))
    found = substring_dedup.deduplicated(documents(spark, data)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in found) == sorted(expected)
    assert sum(r.n_removed for r in found) > 500
    assert substring_dedup.deduplicated(empty(spark)).count() == 0
