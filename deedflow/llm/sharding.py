"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in a seeded random order. A row's fractional
rank is its rank over the size of its source, and all rows are sorted by it:
each stretch of this order then holds every source in its share. The order is
cut into shards whose row counts differ by one at most.

Ranks come from counts of buckets and a ranking within buckets (`ranked`), so
neither a hot source nor the whole order passes through one task. Rows that
are equal in all that counts here are ranked as one weighted row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import GROUP_ROWS, ranked, repeated, staged, text_key, unit

SHARDS = 40
SEED = 20240229


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Placement of every row: `doc_id`, `source`, `size`, `text_crc32`, `shard`, `slot`.

    `size` is the UTF-8 bytes of the text plus 16; a NULL text has none and the
    checksum of an empty one. A NULL source is a source of its own. Equal rows
    get places of their own. Fewer rows than shards leave some shards empty.
    Columns other than `doc_id`, `text` and `source` are not looked at.
    """
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    groups = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (F.octet_length(binary) + 16).cast("long").alias("size"), F.crc32(binary).alias("text_crc32"),
    ).groupBy("doc_id", "source", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_copies"))
    groups = staged(groups, "shard-groups")
    total = groups.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // GROUP_ROWS))

    keys = ["_none", "_name"]
    shuffled = groups.select("*", *text_key("source")).withColumn(
        "_order", unit(F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32"))
    ).withColumn("_bucket", F.floor(F.col("_order") * buckets).cast("long"))
    within = ranked(shuffled, keys, "_bucket", ["_order", "doc_id", "size", "text_crc32"], "_copies")
    rows = repeated(within, "_copies", "_copy")
    # Each source starts at a point of its own, or small sources would meet in the middle.
    phase = unit(F.xxhash64(F.lit(seed + 1), "_none", "_name"))
    share = (F.col("_before") + F.col("_copy") + phase) / F.col("_all")
    rows = rows.select(
        "doc_id", "source", "size", "text_crc32", *keys, F.lit(1).alias("_one"),
        (F.col("_before") + F.col("_copy")).alias("_rank"), share.alias("_share"),
    ).withColumn("_bucket", F.floor(F.col("_share") * buckets).cast("long"))
    placed = ranked(staged(rows, "shard-ranks"), [], "_bucket", ["_share", *keys, "_rank"], "_one")
    shard = F.expr(f"(_before * {shards}L) div {max(total, 1)}L")
    placed = placed.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("_before") - first).cast("long").alias("slot")
    )
