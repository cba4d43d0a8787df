"""Mixing, sharding, neighbours and the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deedflow.llm import mixing, neighbours, sharding
from deedflow.llm.common import table
from fixtures import documents, empty, rows, words

SF_DIR = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(5, 2, 1), limit=3):
    """Targets by rounds: what is above a limit is shared anew among the others."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        whole = sum(weight[n] for n in open_)
        over = {n for n in open_ if left * weight[n] / whole > limit * sizes[n]}
        if not over:
            target |= {n: left * weight[n] / whole for n in open_}
            break
        for n in over:
            target[n] = limit * sizes[n]
        open_ -= over
        left -= sum(target[n] for n in over)
    return target


def test_mix_meets_targets(spark):
    found = mixing.taken_words(documents(spark)).collect()
    assert len(found) == len(rows())
    sizes = collections.Counter()
    for d in rows():
        sizes[d[3]] += len(words(d[1]))
    targets = plain_targets(sizes)
    taken = collections.Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        largest = max(len(words(d[1])) for d in rows() if d[3] == source)
        assert abs(taken[source] - target) <= largest
    again = mixing.taken_words(documents(spark).repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_mixed_rows_are_the_copies(spark):
    docs = documents(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in mixing.taken_words(docs).collect())
    assert mixing.mixed(empty(spark)).count() == 0 and mixing.taken_words(empty(spark)).count() == 0


def test_targets_hold_however_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 2)
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "concat_ws(' ', array_repeat('w', CAST(1 + id % 2 AS int))) AS text", "concat('s', id % 3) AS source")
    found = mixing.taken_words(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(found) == 3 and all(abs(r.taken - r.target) <= 2 for r in found), found


def test_no_level_is_planned_within_another(spark):
    plan = mixing.copies(documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_copies_are_unbiased(spark):
    docs = table(spark, SF_DIR, "documents")
    total = collections.Counter()
    runs = 12
    for seed in range(runs):
        for r in mixing.taken_words(docs, seed=seed).filter("source = 'src0'").collect():
            total[r.doc_id] += r.taken
            rate = r.target / r.source_size
            size = r.source_size
    assert sum(total.values()) / runs == pytest.approx(rate * size, rel=0.1)


def test_shards_are_even_and_follow_the_mixture(spark):
    found = sharding.shard_rows(documents(spark), shards=7).toPandas()
    assert len(found) == len(rows())
    counts = found.shard.value_counts()
    assert counts.max() - counts.min() <= 1 and set(found.shard) == set(range(7))
    for _, group in found.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    expected = sorted((str(d[0]), len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in rows())
    named = [(str(None if np.isnan(i) else int(i)), s, c) for i, s, c in zip(found.doc_id, found["size"], found.text_crc32)]
    assert sorted(named) == expected
    share = found.source.fillna("-").value_counts()
    for source, n in share.items():
        inside = (found.source.fillna("-") == source).groupby(found.shard).sum()
        assert (abs(inside - n / 7) <= 2).all()


def test_shards_of_few_and_no_rows(spark):
    assert sharding.shard_rows(empty(spark)).count() == 0
    found = sharding.shard_rows(documents(spark, rows()[:3])).collect()
    assert len({r.shard for r in found}) == 3 and all(r.slot == 0 for r in found)


def vectors(spark):
    rng = np.random.default_rng(4)
    data = [(k, rng.standard_normal(8).astype("f4").tolist()) for k in range(300)]
    data += [(1000 + k, data[0][1]) for k in range(90)]
    data += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, float("nan"), *[0.0] * 6]), (2060, [float("inf"), *[1.0] * 7]),
             (2080, [None, *[1.0] * 7]), (2100, []), (None, [1.0] * 8), (2120, [1.0, 1.0])]
    return data, spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))


def brute_force(data, nearest, every):
    usable = [(i, np.array(v, "f8")) for i, v in data if i is not None and v and len(v) == 8 and None not in v
              and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            ranked = sorted(((-round(float(v @ w), 10), j) for j, w in usable if j != i))
            out[i] = [j for _, j in ranked[:nearest]]
    return out


def test_neighbours_equal_brute_force_where_windows_cover_all(spark):
    data, df = vectors(spark)
    found = collections.defaultdict(list)
    for r in neighbours.neighbours(df).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert dict(found) == brute_force(data, 20, 20)
    assert neighbours.neighbours(df.limit(0)).count() == 0


@pytest.mark.parametrize("first", [3, 8, 5])
def test_neighbours_of_mixed_lengths_and_repeated_ids(spark, first):
    """Each length by itself, whichever is read first; only the query's own row is no candidate."""
    rng = np.random.default_rng(12)
    data = [(k % 90, rng.standard_normal(size).round(3).tolist()) for size in (first, 3, 5, 8) for k in range(100)]
    data += [(20, data[0][1])] * 3 + [(40, data[5][1])] * 30 + [data[20]] * 2
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").coalesce(1)
    expected = collections.Counter()
    for at, (query, vector) in enumerate(data):
        if query % 20 == 0:
            scores = sorted(
                (-(np.array(vector) * np.array(other)).sum(), i) for j, (i, other) in enumerate(data)
                if j != at and len(other) == len(vector))
            expected.update((query, rank + 1, i, round(-s, 9)) for rank, (s, i) in enumerate(scores[:20]))
    found = neighbours.neighbours(df).collect()
    assert collections.Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found) == expected


def test_neighbours_in_narrow_windows_reach_the_recall(spark):
    rng = np.random.default_rng(6)
    data = [(k, rng.standard_normal(16).tolist()) for k in range(2000)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    matrix = np.array([v for _, v in data])
    found = neighbours.neighbours(df, window=470).toPandas()
    hits = 0
    for query, group in found.groupby("query_id"):
        score = matrix @ matrix[query]
        score[query] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & set(group.vec_id))
        assert np.allclose(group.score, [matrix[query] @ matrix[j] for j in group.vec_id])
    assert hits / (20 * found.query_id.nunique()) >= 0.9


def test_neighbours_keep_the_recall_on_larger_tables(spark, monkeypatch):
    # The bounds are scaled down, so that the table is many times larger than the least window.
    monkeypatch.setattr(neighbours, "WINDOW", 100)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    matrix = np.random.default_rng(8).standard_normal((4000, 64))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    found = neighbours.neighbours(df).toPandas()
    hits = 0
    for query, group in found.groupby("query_id"):
        score = matrix @ matrix[query]
        score[query] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & set(group.vec_id))
    assert len(found) == 4000 and hits / 4000 >= 0.9


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).persist()
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[4] > 0
    placed = corpus_pipeline.run(spark, SF_DIR)
    assert placed.count() == sizes[4]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mix", "shard"]
