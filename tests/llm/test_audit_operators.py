"""Filter audit, license scan and conversation trie against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import Row, functions as F, types as T

import deedflow.llm.filter_audit as filter_audit
from compare import connect, differences
from deedflow.llm import conversation_trie, license_scan, ordered, queries
from deedflow.llm.common import SPACES, UPPER
from fixtures import documents, empty, rows

SF_DIR = "/root/testdata/sf0.001"
TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("k", T.LongType()), T.StructField("depth", T.StringType()),
])


@pytest.mark.parametrize("name", ["op6_substring_dedup", "op11_filter_audit", "op12_license_scan", "op13_conversation_trie"])
def test_queries_equal_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == []


# --- filter audit

def more_rows():
    shout = "THE CAPITALS OF A TEXT"
    extra = [(500, shout), (501, shout), (501, shout), (499, shout), (None, shout), (502, "a\x0bb\x0cc\rd " * 80), (503, "cost | 5%"),
             (504, " ".join(f"word{k}" for k in range(200))), (505, " ".join(f"word{k}" for k in range(199))), (506, "x y " * 100)]
    return rows() + [(i, t, "", None, None, "x", 1.5, 7, 3) for i, t in extra]


def label_rows():
    return [(k, k % 2, int(k % 3 == 0)) for k in range(0, 60, 2)] + [(300, 1, 1), (300, 0, None), (501, 1, 0), (None, 1, 1)]


def plain_audit(data, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    smallest = {}
    for row in data:
        if row[0] is not None:
            smallest[row[1] or ""] = min(row[0], smallest.get(row[1] or "", row[0]))
    fails = collections.defaultdict(list)
    for row in data:
        text = row[1] or ""
        words = [w for w in re.split(f"[{SPACES}]+", text) if w]
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * sum(c in UPPER for c in text) > 3 * len(text):
            failed.add("C")
        if set(text) & set("#$%&*|"):
            failed.add("D")
        if row[0] is not None and row[0] > smallest[text]:
            failed.add("E")
        fails[row[2] or ""].append((failed, row[0] in good, row[0] in toxic))
    out = set()
    for part, docs in fails.items():
        removed_by, rest = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order):
                gone = [d for d in docs if d[0] & set(order[:step])]
                left = [d for d in docs if not d[0] & set(order[:step])]
                hit = [d for d in left if letter in d[0]]
                removed_by[letter] += len(hit)
                rest.append((part, "".join(order), step + 1, len(left) - len(hit), len(hit), sum(letter in d[0] for d in gone),
                             sum(d[0] == {letter} for d in docs), sum(d[1] for d in hit), sum(d[2] for d in hit), letter))
        out |= {(*row[:-1], removed_by[row[-1]]) for row in rest}
    return out


def test_audit_equals_plain_version(spark):
    data, labels = more_rows(), label_rows()
    found = filter_audit.audit(
        documents(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == 600 * len({row[2] or "" for row in data})
    assert set(map(tuple, found)) == plain_audit(data, labels)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty(spark), labels).count() == 0
    assert filter_audit.audit(documents(spark, rows()[:3]), labels).filter("good_lost + toxic_lost > 0").count() == 0


def test_term_matrix_holds_every_word(spark):
    data = more_rows()
    dictionary, matrix = filter_audit.term_matrix(documents(spark, data))
    word = {row.term: bytes(row.word) for row in dictionary.collect()}
    assert sorted(word) == list(range(len(word))) and len(set(word.values())) == len(word)
    found = collections.Counter()
    for shard in matrix.collect():
        starts = filter_audit.unpacked(bytes(shard.starts), "u8")
        indices, counts = filter_audit.unpacked(bytes(shard.indices), "u8"), filter_audit.unpacked(bytes(shard.counts), "u4")
        for k, doc_id in enumerate(shard.doc_ids):
            cells = zip(indices[starts[k]:starts[k + 1]].tolist(), counts[starts[k]:starts[k + 1]].tolist())
            found[doc_id, frozenset((word[i], n) for i, n in cells)] += 1
    expected = collections.Counter(
        (row[0], frozenset(collections.Counter((row[1] or "").encode().split()).items())) for row in data)
    assert found == expected


# --- license scan

def license_rows():
    passage = license_scan.PASSAGES["mit"][0]
    wrapped = "\n".join(passage[k:k + 60] for k in range(0, len(passage), 60))
    rng = random.Random(3)
    words = passage.split()
    rare = " ".join(w if rng.random() < 0.9 else "other" for w in words)
    half = " ".join(words[:len(words) // 3])
    texts = [
        None, "", " \n ", "Licensed under CC BY-NC 4.0.", "cc by cc by", "CC\nBY", "All Rights Reserved. GENERAL PUBLIC LICENSE",
        "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.",
        "mit der license\nlicense", "the mit " + "x " * 70 + "license", "x " * 300 + wrapped.upper() + " y" * 900, rare, half, "ccby cc-by1 cc by\x00",
        "é cc by é", "K cc by", "word " * 40_000 + "apache license, version 2.0", "cc by " * 3000,
    ]
    data = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3])] * 2 + [(None, texts[8]), (None, texts[7]), (3, "other")]
    return [(i, t, "en", "a", None, "x", 0.5, 7, 3) for i, t in data]


def plain_licenses(text):
    low = "".join(chr(ord(c) + 32) if c in UPPER else c for c in text or "")
    cut = lambda part: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", part)
    words = cut(low)
    places = {i: label for phrase, label in license_scan.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()}
    labels, best = set(places.values()), 0.0
    for notices, size, blocks in ((license_scan.LINES, license_scan.LINE_WORDS, [cut(line) for line in low.split("\n")]),
                                  (license_scan.PASSAGES, license_scan.PASSAGE_WORDS, [words])):
        for block in blocks:
            for start in range(0, max(len(block) - size // 2, 1), size // 2):
                have = set(block[start:start + size])
                for label, texts in notices.items():
                    for own in map(set, map(str.split, texts)):
                        if len(own & have) >= math.ceil(round(0.8 * len(own), 9)):
                            labels.add(label)
                            best = max(best, len(own & have) / len(own))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(set(places.values()))), ",".join(sorted(labels)), 1.0 if places else best)


def test_licenses_equal_plain_version(spark):
    data = license_rows()
    found = license_scan.licenses(documents(spark, data)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((row[0], *plain_licenses(row[1]))) for row in data)
    by_id = {row.doc_id: row for row in found}
    assert by_id[11].labels == "mit" and by_id[12].labels == "mit" and by_id[13].labels == "" and by_id[9].labels == ""
    assert by_id[18].n_base == 3000 and by_id[18].last_word == 5998


def test_licenses_of_nothing_and_of_many_copies(spark):
    assert license_scan.licenses(empty(spark)).count() == 0
    copies = spark.range(3000).selectExpr("if(id % 3 = 0, NULL, id) AS doc_id", "'Released under the MIT License.' AS text")
    assert license_scan.licenses(copies).filter("labels = 'mit'").count() == 3000


def test_license_scan_stays_native(spark):
    plan = license_scan.licenses(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- conversation trie

def conversation_rows():
    rng = random.Random(5)
    data = []
    for conv in range(0, 130):
        if conv % 20 == 0 and conv in (40, 60):
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            data.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "yes", "", None, "a b c"])))
    data += [(200, k, "user", f"turn {k} of many") for k in range(500)]
    data += [(220, 1, "user", "hi"), (220, None, "system", "be kind"), (220, 1, "user", "hi"), (220, 0, None, None)]
    data += [(-7, 0, "user", "below zero"), (-20, 3, "user", "yes"), (None, 0, "user", "lost"), (1000, 5, "user", "yes")] * 2
    return [(*row, 5, "x") for row in data]


def plain_trie(data):
    turns = collections.defaultdict(list)
    for conv, turn, role, text, *_ in data:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:30]
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {conv: [turn[3:] for turn in sorted(some)] for conv, some in turns.items()}
    built, nodes, kids = {}, collections.defaultdict(list), collections.defaultdict(list)
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        built[conv] = tuple(turns.get(conv - int(math.fmod(conv, 20)), [])[:h] + own[h:])
        for depth in range(len(built[conv]) + 1):
            nodes[built[conv][:depth]].append(conv)
    leaves, saved, out = {}, {}, set()
    for node in sorted(nodes, key=len, reverse=True):
        if node:
            kids[node[:-1]].append(node)
        members = nodes[node]
        leaves[node] = sum(leaves[kid] for kid in kids[node]) or 1
        saved[node] = sum(saved[kid] for kid in kids[node]) + (len(members) - 1) * (len(node[-1][1].split()) if node else 0)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(node))))
        out.add((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(kids[node]), leaves[node],
                 saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("arcs,short", [(1 << 17, 1 << 16), (200, 20)])
def test_trie_equals_plain_version(spark, monkeypatch, arcs, short):
    monkeypatch.setattr(ordered, "TASK_ARCS", arcs)
    monkeypatch.setattr(ordered, "SHORT", short)
    data = conversation_rows()
    found = conversation_trie.trie(spark.createDataFrame(data, TURNS).repartition(5)).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert set(map(tuple, found)) == plain_trie(data)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert conversation_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert conversation_trie.trie(spark.createDataFrame([(None, 0, "a", "b", 1, "x")], TURNS)).count() == 0
    few = [(conv, 0, "user", "one", 1, "x") for conv in range(1, 20)]
    found = conversation_trie.trie(spark.createDataFrame(few, TURNS)).collect()
    assert set(map(tuple, found)) == plain_trie(few) and any(row.depth == 0 and row.ends_sha256 != conversation_trie.NOBODY for row in found)


def test_one_conversation_of_a_third_of_all_rows(spark):
    big = spark.range(60_000).selectExpr("if(id % 3 = 0, 5L, id) AS conv_id", "0L AS turn", "'user' AS role", "'same' AS text")
    found = conversation_trie.trie(big)
    assert found.agg(F.max("depth")).first()[0] >= 19_997
    assert found.filter("depth = 0").select("n_convs").first()[0] == big.select("conv_id").distinct().count()


@pytest.mark.parametrize("seed", [1, 2])
def test_list_sums_of_shuffled_lists(spark, monkeypatch, seed):
    monkeypatch.setattr(ordered, "TASK_ARCS", 128)
    monkeypatch.setattr(ordered, "SHORT", 16)
    rng = random.Random(seed)
    ids = rng.sample(range(10_000), 1500)
    weights = [(rng.randrange(5), rng.randrange(100)) for _ in ids]
    arcs = [(i, n, *w) for i, n, w in zip(ids, [*ids[1:], -1], weights)]
    rng.shuffle(arcs)
    found = {r.id: (r.before1, r.before2) for r in ordered.list_sums(spark.createDataFrame(arcs, "id long, next long, w1 long, w2 long")).collect()}
    first = second = 0
    for i, (a, b) in zip(ids, weights):
        assert found[i] == (first, second)
        first, second = first + a, second + b
    assert len(found) == len(ids)


def test_scan_carries_groups_over_partitions(spark):
    data = [Row(g=k // 700, o=k % 700, v=k * 10**15) for k in range(3000)]
    random.Random(1).shuffle(data)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = ordered.scanned(spark.createDataFrame(data), "g", ["o"], "scan", sums=["v"], lag="o").orderBy("_at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    total = 0
    for k, row in enumerate(found):
        total = k * 10**15 + (total if k % 700 else 0)
        assert (row._at, row._pos, row.g, row.o) == (k, k % 700 + 1, k // 700, k % 700)
        assert row.v == total & ordered.MASK and row._lag == (None if k % 700 == 0 else k % 700 - 1)
