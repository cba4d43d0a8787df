"""Line dedup over range-partitioned line hashes.

Each long line becomes a 128-bit hash with its document and position; no text
is shuffled for the search. Hashes are range-partitioned with a secondary sort,
largest document first, then position: the first row of a run is the occurrence that
stays. A run is cut into `SEGMENTS` by document, so that a line in a third of
all documents spreads over many partitions, and the segments of a key are put
together from one row each. The answer is one sparse bitmap per document that
drops lines, and only applying it touches the texts again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from deedflow.llm.common import SPACES, ascii_lower, staged

MIN_CHARS = 40
MIN_DOCUMENTS = 5
SEGMENTS = 64
ROW = ("_null", "_id", "_t1", "_t2")


def line_key(line: Column) -> Column:
    """A line stripped of white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").isNull().alias("_null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(7), text).alias("_t2"), text.alias("_body"),
    )


def drop_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Per document that loses lines, its bitmap as `_words`: 64 lines per number, empty numbers left out.

    Documents are rows, and a row is known by its id and two hashes of its text;
    equal rows count as documents of their own and share one bitmap. A NULL id
    is below all others.
    """
    lines = _identified(docs).select(*ROW, F.posexplode(F.split("_body", "\n")).alias("_pos", "_line"))
    keys = lines.withColumn("_key", line_key(F.col("_line"))).filter(F.char_length("_key") >= min_chars)
    occurrences = keys.select(
        F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), "_key").alias("_h2"),
        F.pmod(F.xxhash64("_id", "_t1"), F.lit(SEGMENTS)).cast("int").alias("_segment"), *ROW, "_pos",
    )
    # Equal rows repeat their occurrences, which then count as one with a weight.
    occurrences = occurrences.groupBy("_h1", "_h2", "_segment", *ROW, "_pos").agg(F.count(F.lit(1)).alias("_copies"))
    occurrences = staged(occurrences, "line-hashes")
    run = ["_h1", "_h2", "_segment"]
    ranged = occurrences.repartitionByRange(*[F.col(name) for name in run])
    ordered = Window.partitionBy(*run).orderBy(F.col("_null"), F.col("_id").desc(), "_t1", "_t2", "_pos")
    previous = F.lag(F.struct(*ROW)).over(ordered)
    streamed = ranged.withColumn("_new", F.when(previous.eqNullSafe(F.struct(*ROW)), 0).otherwise(F.col("_copies")))
    segments = streamed.groupBy(*run).agg(
        F.sum("_new").alias("_documents"), F.min(F.struct("_null", (-F.col("_id")).alias("_negative"))).alias("_first")
    )
    frequent = segments.groupBy("_h1", "_h2").agg(
        F.sum("_documents").alias("_documents"), F.min("_first").alias("_first")
    ).filter(F.col("_documents") >= min_documents).select("_h1", "_h2", "_first")
    # The verdict goes back by run, as a frequent key has many occurrences but few runs.
    runs = segments.select(*run).join(frequent, ["_h1", "_h2"])
    dropped = occurrences.join(runs, run).filter(
        ~((F.col("_null") == F.col("_first._null")) & (F.col("_id") == -F.col("_first._negative")))
    )
    words = dropped.groupBy(*ROW, F.expr("_pos div 64").cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_pos % 64 AS int))")).alias("_bits")
    )
    return words.groupBy(*ROW).agg(F.expr("map_from_entries(collect_list(struct(_word, _bits))) AS _words"))


def deduplicated(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Every document with `kept_text`, `n_lines` before and `n_dropped`, under its `doc_id`.

    Keys of `min_chars` code points or more in at least `min_documents` documents
    lose all lines but those of the largest id that holds them. A NULL or empty
    text is one empty line. No rows give no rows.
    """
    bitmaps = drop_bitmaps(docs, min_chars, min_documents)
    joined = _identified(docs).join(bitmaps, list(ROW), "left")
    bit = "shiftright(coalesce(_words[CAST(k div 64 AS int)], 0L), CAST(k % 64 AS int)) & 1L"
    kept = F.expr(
        f"if(_words IS NULL, _body, array_join(filter(split(_body, '\\n'), (l, k) -> ({bit}) = 0L), '\\n'))"
    )
    count = F.expr("coalesce(aggregate(map_values(_words), 0L, (n, w) -> n + bit_count(w)), 0L)")
    return joined.select(
        F.when(~F.col("_null"), F.col("_id")).alias("doc_id"), kept.alias("kept_text"),
        (F.char_length("_body") - F.char_length(F.translate("_body", "\n", "")) + 1).cast("long").alias("n_lines"),
        count.alias("n_dropped"),
    )
