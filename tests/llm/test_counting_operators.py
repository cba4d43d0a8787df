"""Language model scores, token counts and toxicity against plain counterparts."""

import collections
import math
import sys
import zlib

import numpy as np
import pytest

from deedflow.llm import language_model, token_counts, toxicity
from deedflow.llm.common import table
from fixtures import documents, empty, rows, words

SF_DIR = "/root/testdata/sf0.001"


def held(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


class Reference:
    """The mixture of the language model over plain counters."""

    def __init__(self, texts, settings_mass):
        self.mass = settings_mass
        self.one, self.two, self.three = (collections.Counter() for _ in range(3))
        for tokens in texts:
            padded = ["<s>", "<s>", *tokens]
            self.one.update(tokens)
            self.two.update(zip(padded[1:], padded[2:]))
            self.three.update(zip(padded, padded[1:], padded[2:]))
        self.total, self.texts = sum(self.one.values()), len(texts)
        self.whole = self.total + 0.1 * (len(self.one) + 1)

    def base(self, tokens):
        return sum(math.log10((self.one[t] + 0.1) / self.whole) for t in tokens)

    def score(self, tokens):
        padded, out = ["<s>", "<s>", *tokens], 0
        for a, b, w in zip(padded, padded[1:], padded[2:]):
            one = self.texts if b == "<s>" else self.one[b]
            two = self.texts if b == "<s>" else self.two[(a, b)]
            m = self.mass(b)
            over = 30 * self.three[(a, b, w)] + self.two[(b, w)] + m * (self.one[w] + 0.1) / self.whole
            out += math.log10(over / (30 * two + one + m))
        return out


def _mass(counts):
    slots = {}

    def slot(token):
        plain = {"</s>": b" end", "<s>": b" start"}.get(token, token)
        return language_model.xxhash.xxh64_intdigest(plain) & ((1 << language_model.SLOT_BITS) - 1)

    for token, n in counts.items():
        slots[slot(token)] = max(slots.get(slot(token), 0), 1 + math.floor(4 * math.log2(n)))

    def mass(token):
        level = slots.get(slot(token), 0)
        return 8 * (1 + (2 ** ((level - 1) / 4) if level else 0)) ** 0.8
    return mass


@pytest.mark.parametrize("split", [17, 2])
def test_scores_equal_the_plain_model(spark, monkeypatch, split):
    # With a low limit frequent words are split over shards.
    monkeypatch.setattr(language_model, "SPLIT", split)
    texts = {}
    for doc_id, text, *_ in rows():
        texts.setdefault(doc_id, []).append([*[w.lower() for w in words(text)], "</s>"])
    training = [t for i, group in texts.items() for t in group if not held(i, 10)]
    counts = collections.Counter(t for text in training for t in text)
    model = Reference(training, _mass(counts))
    result = language_model.scores(documents(spark)).collect()
    assert len(result) == len(rows())
    for row in result:
        tokens = texts[row.doc_id]
        assert row.held_out == held(row.doc_id, 10) and row.train_tokens == model.total
        near = [t for t in tokens if len(t) == row.n_tokens]
        assert near and row.n_known == sum(model.one[t] > 0 for t in near[0])
        assert row.base_score == pytest.approx(model.base(near[0]), rel=1e-9)
        assert abs(row.score - model.score(near[0])) <= len(near[0]) / language_model.STEPS


def test_a_word_whose_parts_share_a_shard_is_counted_once(spark):
    # So many ends are split, and there are few shards.
    texts = spark.range(300_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', NULL) AS text")
    kept = [k for k in range(300_000) if not held(k, 10)]
    ends, hot = len(kept), sum(k % 3 == 0 for k in kept)
    found = language_model.scores(texts).groupBy("n_tokens").agg({"base_score": "avg", "train_tokens": "max"}).collect()
    whole = ends + hot + 0.1 * 3
    end, word = math.log10((ends + 0.1) / whole), math.log10((hot + 0.1) / whole)
    base = {r["n_tokens"]: r["avg(base_score)"] for r in found}
    assert base == {1: pytest.approx(end, rel=1e-9), 2: pytest.approx(end + word, rel=1e-9)}
    assert {r["max(train_tokens)"] for r in found} == {ends + hot}


def test_model_beats_unigrams_on_held_out_texts(spark):
    found = language_model.scores(table(spark, SF_DIR, "documents")).filter("held_out").toPandas()
    assert found.score.sum() > found.base_score.sum()


def test_score_of_a_very_long_text_does_not_overflow(spark):
    # All steps of an unknown word lie in one shard, and together they pass 32 bits.
    name, count = next(k for k in range(1000, 2000) if held(k, 10)), 600_000
    data = [*rows(), (name, "unseen " * count, "en", "a", 0, "x", 0.0, 0, 0)]
    found = next(r for r in language_model.scores(documents(spark, data)).collect() if r.doc_id == name)
    assert found.held_out and found.n_tokens == count + 1
    assert found.base_score * language_model.STEPS < -2**31
    assert abs(found.score - found.base_score) < 0.0005 * count + 30


def test_scores_of_no_rows_and_of_no_training_rows(spark):
    assert language_model.scores(empty(spark)).count() == 0
    out = [r for r in rows() if held(r[0], 10)][:2]
    found = language_model.scores(documents(spark, out)).collect()
    assert len(found) == 2 and all(r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9 for r in found)


def test_distinct_keys_are_those_of_numpy():
    rng = np.random.default_rng(4)
    wide = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    # Keys that only their last bits tell apart, mixed.
    near = np.uint64(1 << 63) + rng.integers(0, 3, 3000).astype(np.uint64)
    for keys in (wide, near, np.concatenate([wide, near, wide]), rng.integers(0, 9, 100), np.zeros(0, np.int64), np.array([7]), np.zeros(5, np.int64)):
        unique, inverse = language_model._unique(keys)
        assert unique.dtype == keys.dtype and (unique == np.unique(keys)).all() and (unique[inverse] == keys).all()


def test_elias_fano_returns_and_finds_its_values():
    rng = np.random.default_rng(3)
    for values in ([], [0], [5, 5], np.sort(rng.integers(0, 1 << 50, 70_000)), np.arange(40_000), np.full(3, (1 << 63) - 1)):
        values = np.array(values, np.uint64)
        scratch = language_model.Scratch()
        sequence = language_model.Sequence(scratch, values)
        scratch.close()
        assert (sequence.values() == values).all()
        queries = np.unique(np.concatenate([values, rng.integers(0, 1 << 50, 1000).astype(np.uint64)]))
        places = sequence.find(queries)
        assert ((places >= 0) == np.isin(queries, values)).all()
        assert (values[places[places >= 0]] == queries[places >= 0]).all()


STRINGS = [
    None, "", " ", "<|endoftext|> a", "a<|startoftext|>b", "İstanbul ΣΑΣ", "naïve é", "I'll we've 'S 't's !!'s   x y",
    "１２３ a1b2", "\x85\x1c\x1dz", "ſ K Å", "\x00\x1f a", "日本語 text", "é", "x" * 5000, "don't'll", "ß SS ŉ",
]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_counts.tokenizer_path())
    data = [(k, text, "en", "a", 0, "x", 0.0, 0, 0) for k, text in enumerate(STRINGS)] + rows()
    found = token_counts.token_counts(documents(spark, data)).collect()
    expected = sorted(
        (str(d[0]), len((d[1] or "").encode()), len(library.encode(d[1] or "", add_special_tokens=False).ids)) for d in data)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == expected
    assert all(r.over_limit == (r.n_tokens > 2048) for r in found)
    assert token_counts.token_counts(empty(spark)).count() == 0


def test_single_tokens_are_proved():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_counts.tokenizer_path())
    known = token_counts.single_tokens(library, token_counts._pattern(library.to_str()))
    assert len(known) > 10_000 and "the" in known and "zzzzqqqq" not in known


def test_toxicity_learns_and_leaves_clean_documents_alone(spark):
    # The smaller tables hold out too few toxic rows to tell.
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    joined = found.join(labels, "doc_id").withColumn("held_out", toxicity.fold(5) == 0).toPandas()
    assert ((joined.predicted == 1) & (joined.toxic == 0)).sum() <= 0.02 * len(joined)
    out = joined[joined.held_out]
    assert (out.predicted == out.toxic).mean() >= 0.97
    assert joined.score.between(0, 1).all()


def _word_buckets(text):
    """Buckets of the words of a text by their definition, each part hashed as a whole."""
    words = [word.strip(toxicity.STRIP) for word in (text or "").lower().split()]
    return [[zlib.crc32(part.encode("utf-8", "replace")) % (toxicity.BUCKETS - 1) + 1
             for part in ("w" + word, "4" + word[:4], "6" + word[:6])] for word in words]


def test_known_words_take_no_python_step_each():
    texts = [" ".join(f"known{k}" for k in range(3000))] * 2
    toxicity.word_ids(texts)
    lines = 0

    def count(frame, event, arg):
        nonlocal lines
        lines += event == "line"
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        found = toxicity.word_ids(texts)
    finally:
        sys.settrace(before)
    assert lines < 100
    assert [ids.tolist() for ids in found] == [_word_buckets(text) for text in texts]


@pytest.mark.parametrize("remembered", [0, 5, 300_000])
def test_word_ids_are_the_hashes_of_their_parts(monkeypatch, remembered):
    monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
    texts = ["Good day, good DAY!", None, "", " \n", "... élève ÉLÈVES straße İstanbul \ud800x y\ud800zzzzz", "good (abcdefgh) abcd", "日本語のテキスト word"]
    for _ in range(3):
        for size in (1, 3, len(texts)):
            for at in range(0, len(texts), size):
                found = toxicity.word_ids(texts[at:at + size])
                assert [ids.tolist() for ids in found] == [_word_buckets(text) for text in texts[at:at + size]]
                assert all(ids.dtype == np.int32 and ids.shape[1] == toxicity.PARTS for ids in found)
    assert toxicity.word_ids([]) == []


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 0), (3, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    found = toxicity.toxicity(documents(spark), labels).collect()
    assert len(found) == len(rows()) and all(0 <= r.score <= 1 for r in found)
    blank = {r.score for r in found if r.doc_id in (200, 201, 202)}
    assert len(blank) == 1
    kept = toxicity.accepted(documents(spark), labels)
    assert kept.columns == documents(spark).columns
    assert kept.count() == sum(r.predicted == 0 for r in found)
    none = labels.limit(0)
    assert toxicity.toxicity(documents(spark), none).count() == len(rows())
    assert toxicity.toxicity(empty(spark), labels).count() == 0


@pytest.mark.parametrize("labelled", [[], [(1, 1), (2, 1)], [(1, 0), (2, 0)]])
def test_toxicity_without_both_labels_rejects_nothing(spark, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    found = toxicity.toxicity(documents(spark), labels).collect()
    assert len({r.score for r in found}) == 1 and not any(r.predicted or r.flagged for r in found)
    assert toxicity.accepted(documents(spark), labels).count() == len(rows())


def test_toxicity_learns_once_from_rows_of_one_id(spark, monkeypatch):
    learned = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic: learned.append(len(texts)) or toxicity.Model())
    data = [r for r in rows() if r[0] in (1, 2, 3, 4)] + [(3, f"another text {k}", *rows()[3][2:]) for k in range(500)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, toxic int")
    toxicity.fit(documents(spark, data), labels, folds=1000)
    assert max(learned) <= 4


def test_toxicity_learns_and_calibrates_from_all_labelled_rows(spark):
    # The first model sees one row of each label; the words that tell are in the others alone.
    data = [(k, ("bad" if k % 2 else "fine") + f" thing {k % 7}" if k > 100 else "plain", "en" if k % 3 else "de",
             "a", 0, "x", 0.0, 0, 0) for k in range(1200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1200)], "doc_id long, toxic int")
    rows = toxicity._labelled(documents(spark, data), labels, 5)
    assert rows.count() == sum(not held(k, 5) for k in range(1200))
    model, thresholds = toxicity.fit(documents(spark, data), labels, sample=1)
    good, bad = model.scores(toxicity.word_ids(["fine thing 3", "bad thing 3"]))
    assert good < 0.5 < bad and set(thresholds) == {"de", "en"}
    counted = toxicity._histogram(rows.filter("pmod(_order, 5) = 0"), model)
    assert sum(r.n for r in counted) == rows.filter("pmod(_order, 5) = 0").count() > 100


def test_counted_scores_give_the_threshold_of_single_rows():
    rng = np.random.default_rng(5)
    scores = rng.integers(1, 20, 400) / 20
    labels = (rng.random(400) < scores).astype(np.int64)
    pairs, times = np.unique(np.stack([scores, labels]), axis=1, return_counts=True)
    assert toxicity.best_threshold(pairs[0], pairs[1], times) == pytest.approx(toxicity.best_threshold(scores, labels))


def test_pipeline_decides_by_the_threshold_of_the_language(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "fit", lambda *_: (toxicity.Model(), {"en": 0.0, "de": 1.0}))
    docs = documents(spark)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.toxicity(docs, labels).collect()
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    langs = [r.lang for r in kept.select("lang").collect()]
    assert "en" not in langs
    assert langs.count("de") == docs.filter("lang = 'de'").count()
    assert len(langs) == sum(not r.flagged for r in scored) != sum(r.predicted == 0 for r in scored)


def test_long_texts_are_scored_whole():
    model = toxicity.train(
        toxicity.word_ids(["good day to you"] * 40 + ["good day stupid clown to you"] * 40), np.array([0] * 40 + [1] * 40, np.float32))
    clean, bad = "good day to you " * 30_000, "good day to you " * 30_000 + "stupid clown"
    scores = model.scores(toxicity.word_ids([clean, bad, "good day", "stupid clown", None]))
    assert scores[0] < 0.5 < scores[1] and scores[2] < 0.5 < scores[3] and scores[4] < 0.5
