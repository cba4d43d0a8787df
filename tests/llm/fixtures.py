"""Small corpora with the awkward rows: NULLs, empty and long texts, repeats, ties."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Named like columns that operators use inside.
    T.StructField("_text", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("_copies", T.LongType()), T.StructField("shard", T.IntegerType()),
])


def prose(rng, count, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}x" for _ in range(count))


def rows(seed=1, count=60):
    rng = random.Random(seed)
    passage = prose(rng, 60)
    line = "This very common line has more than forty letters, and Case."
    out = []
    for k in range(count):
        text = prose(rng, rng.choice([1, 2, 3, 30, 80, 200]))
        if k % 5 == 0:
            text += "\n \t" + (line.upper() if k % 2 else line) + " \n" + prose(rng, 20)
        if k % 7 == 0:
            text += " " + passage + " " + prose(rng, 5)
        out.append((k, text))
    out += [(100 + k, out[3][1] + "\n" + out[10][1]) for k in range(8)]
    out += [(200, None), (201, ""), (202, "  \t\n "), (203, "one"), (204, "One"), (205, prose(rng, 30_000))]
    out += [(300, "the same row " * 30)] * 3 + [(None, "a row without id " * 12)] * 2 + [(None, None)]
    out += [(400, "é ü  x " * 20), (401, out[20][1].replace("w1x", "w2x", 1))]
    sources = ["a", "b", None, "c", "B"]
    return [
        (i, t, ["en", "de", None][k % 3], "a" if k % 3 == 0 else sources[k % 5], None if t is None else len(t), "x", 1.5, 7, 3)
        for k, (i, t) in enumerate(out)
    ]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()
