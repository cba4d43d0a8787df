"""License notices in texts, by an exact set-similarity join with templates.

A notice is a set of words. Texts are cut into blocks: lines for short notices, and
overlapping windows over all lines for passages. A block holds a notice if it
contains at least `THRESHOLD` of its words. Only words of notices can match,
so a block is the set of those words that it has.

The join is the one of prefix filtering: words are ordered by how few blocks hold them,
all over the table. A notice of n words of which a must be found shares a word of its
first n - a + 1 with any block that holds it, and that word lies in the first m - a + 1 of the
block's m. So only prefixes are joined; blocks that are too short are left out before
(length), pairs whose rest is too short after (position), and what is left is counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedflow.llm.common import ascii_lower, staged

THRESHOLD = 0.8
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OTHER_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
# Longer lines are cut into overlapping blocks; passages always are.
LINE_WORDS, PASSAGE_WORDS = 64, 256

# Phrases whose places are counted, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Short notices. Up to four words must all be in one line.
LINES = {
    "mit": ["the mit license", "under mit license"],
    "apache-2.0": ["apache license version 2"],
    "bsd": ["bsd license", "bsd clause"],
    "isc": ["isc license"],
    "gpl": ["gnu general public license"],
    "lgpl": ["gnu lesser general public", "gnu library general public"],
    "agpl": ["gnu affero general public"],
    "gfdl": ["gnu free documentation license"],
    "mpl": ["mozilla public license"],
    "epl": ["eclipse public license"],
    "boost": ["boost software license"],
    "cc-by": ["creative commons attribution"],
    "cc-by-nc": ["cc by nc", "creative commons attribution noncommercial"],
    "cc-by-nd": ["cc by nd", "creative commons attribution noderivatives"],
    "cc-by-sa": ["cc by sa", "creative commons attribution sharealike"],
    "cc0": ["cc0", "creative commons zero"],
    "public-domain": ["dedicated public domain", "released public domain"],
}
# Well-known paragraphs of licenses.
PASSAGES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "gpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version of the license or at your option any later "
        "version",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software",
    ],
}


def words_of(text: Column) -> Column:
    """Words side by side with one space between: ASCII letters and digits, and all other characters above them."""
    return F.btrim(F.regexp_replace(text, OTHER, " "))


def _count(joined: Column) -> Column:
    return F.when(joined == "", 0).otherwise(F.length(joined) - F.length(F.replace(joined, F.lit(" "))) + 1).cast("long")


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds `_joined` words, `n_words`, and places and labels of `PHRASES` in a lower-case text column."""
    joined = docs.withColumn("_joined", words_of(F.col(text)))
    spaced = F.concat(F.lit(" "), F.col("_joined"), F.lit(" "))
    # Cut before each phrase, so that what lies before and after its places can be counted.
    pieces = joined.withColumn("n_words", _count(F.col("_joined"))).withColumn(
        "_pieces", F.split(spaced, f"(?<= )(?=(?:{'|'.join(PHRASES)}) )"))
    places = (F.size("_pieces") - 1).cast("long")
    labels = F.array_compact(F.array(*[
        F.when(F.contains(spaced, F.lit(f" {phrase} ")), F.lit(label)) for phrase, label in PHRASES.items()]))
    return pieces.withColumns({
        "n_base": places,
        "first_word": F.when(places > 0, _count(F.btrim(F.element_at("_pieces", 1)))),
        "last_word": F.when(places > 0, F.col("n_words") - _count(F.btrim(F.element_at("_pieces", -1)))),
        "_base": F.array_sort(F.array_distinct(labels)),
    }).drop("_pieces")


def _sets(notices: Mapping[str, Sequence[str]]) -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(text.split()))) for label, texts in notices.items() for text in texts]


def needed(size: int, threshold: float) -> int:
    """Words of a notice that a block must hold."""
    return math.ceil(round(threshold * size, 9))


def _blocks(docs: DataFrame, kind: int, sets: list[tuple[str, list[str]]], size: int, threshold: float) -> DataFrame:
    """Blocks of one kind as the set of the notices' words in them (`words`), those that are long enough for some notice.

    A whole text that has too few of these words is not cut up.
    """
    vocabulary = F.array(*[F.lit(word) for word in sorted({word for _, words in sets for word in words})])
    least = min(needed(len(words), threshold) for _, words in sets)
    known = F.array_intersect(F.split("_joined", " "), vocabulary)
    rows = docs.filter(F.size(known) >= least)
    if kind == 0:
        lines = F.split(F.regexp_replace("_lower", OTHER_IN_LINE, " "), "\n")
        rows = rows.select("_key", F.explode(lines).alias("line")).select("_key", F.split(F.btrim("line"), " ").alias("all"))
    else:
        rows = rows.select("_key", F.split("_joined", " ").alias("all"))
    half = size // 2
    starts = F.expr(f"sequence(1, greatest(size(all) - {half}, 1), {half})")
    return rows.select("_key", F.explode(starts).alias("at"), "all").select(
        "_key", F.lit(kind).alias("kind"), F.array_intersect(F.slice("all", F.col("at"), F.lit(size)), vocabulary).alias("words")
    ).filter(F.size("words") >= least)


def found_notices(
    docs: DataFrame,
    lines: Mapping[str, Sequence[str]] = LINES,
    passages: Mapping[str, Sequence[str]] = PASSAGES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per `_key` of `docs` (`_key`, `_lower`, `_joined`) the `label`s found and the largest containment as `found`.

    Notices of `passages` may be spread over lines; they are found whole if they take up to half a window.
    """
    kinds = [(_sets(lines), LINE_WORDS), (_sets(passages), PASSAGE_WORDS)]
    kinds = [(kind, sets, size) for kind, (sets, size) in enumerate(kinds) if sets]
    blocks = None
    for kind, sets, size in kinds:
        some = _blocks(docs, kind, sets, size, threshold)
        blocks = some if blocks is None else blocks.unionByName(some)
    blocks = staged(blocks, "license-blocks")
    # One row per word of a notice: fewest blocks first.
    counted = blocks.select("kind", F.explode("words").alias("word")).groupBy("kind", "word").count()
    frequency = {(row["kind"], row["word"]): row["count"] for row in counted.collect()}
    ranks, notices, least = [], [], {}
    for kind, sets, _ in kinds:
        vocabulary = sorted({word for _, words in sets for word in words}, key=lambda w: (frequency.get((kind, w), 0), w))
        place = {word: rank for rank, word in enumerate(vocabulary)}
        ranks.append(F.when(F.col("kind") == kind, F.create_map(*[F.lit(part) for pair in place.items() for part in pair])))
        least[kind] = min(needed(len(words), threshold) for _, words in sets)
        for label, words in sets:
            own, must = sorted(place[word] for word in words), needed(len(words), threshold)
            notices += [(kind, rank, i + 1, label, own, must) for i, rank in enumerate(own[:len(own) - must + 1])]
    ranked = blocks.withColumn("rank_of", F.coalesce(*ranks)).select(
        "_key", "kind", F.expr("array_sort(transform(words, w -> rank_of[w])) AS have"))
    shortest = F.expr("CASE kind " + " ".join(f"WHEN {kind} THEN {n}" for kind, n in least.items()) + " END")
    prefixes = ranked.select(
        "_key", "kind", "have", F.posexplode(F.slice("have", F.lit(1), F.size("have") - shortest + 1)).alias("_j", "rank"))
    # As many rows as the notices have words at most.
    templates = docs.sparkSession.createDataFrame(
        notices, "kind int, rank int, i int, label string, own array<int>, must int")
    m, n, j = F.size("have"), F.size("own"), F.col("_j") + 1
    pairs = prefixes.join(templates, ["kind", "rank"]).filter(
        (m >= F.col("must")) & (j <= m - F.col("must") + 1)
        & (1 + F.least(n - F.col("i"), m - j) >= F.col("must")))
    shared = F.size(F.array_intersect("have", "own"))
    return pairs.filter(shared >= F.col("must")).groupBy("_key").agg(
        F.collect_set("label").alias("_found_labels"), F.max(shared / n).alias("found"))


def licenses(
    docs: DataFrame,
    lines: Mapping[str, Sequence[str]] = LINES,
    passages: Mapping[str, Sequence[str]] = PASSAGES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    `n_base` counts the places of `PHRASES`, overlapping ones too; labels are sorted and joined by commas, empty if
    there are none. `score` is 1 with a phrase, else the largest part of a notice that one block contains, 0 if none
    contains enough. NULL is an empty text, which has no words. Rows equal in id and text are found alike. Other
    columns are not looked at.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    plain = F.octet_length("_text") == F.length("_text")
    rows = rows.select(
        "doc_id", F.when(plain, F.lower("_text")).otherwise(ascii_lower(F.col("_text"))).alias("_lower"),
        F.struct(F.col("doc_id").cast("string").alias("id"), F.xxhash64("_text").alias("h"), F.crc32(F.col("_text").cast("binary")).alias("c")).alias("_key"))
    # Read twice: once for the phrases of all rows, once for the blocks.
    based = with_base(rows, "_lower")
    notices = staged(found_notices(based.select("_key", "_lower", "_joined"), lines, passages, threshold), "licenses")
    merged = F.array_sort(F.array_union("_base", F.coalesce("_found_labels", F.array().cast("array<string>"))))
    same = [rows_key.eqNullSafe(found_key) for rows_key, found_key in (
        (F.col(f"_key.{part}"), F.col(f"_other.{part}")) for part in ("id", "h", "c"))]
    return based.drop("_lower", "_joined").join(
        notices.withColumnRenamed("_key", "_other"), same, "left"
    ).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"),
        F.array_join(merged, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("found", F.lit(0.0))).alias("score"))
