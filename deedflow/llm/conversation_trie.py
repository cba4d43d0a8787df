"""Prefix trie of conversations, with sums over subtrees by the Euler-tour technique.

A node is known by its smallest member and its depth, so each conversation owns one
unbroken chain of nodes, and numbering nodes in order of conversation and depth gives the
successor on a chain for free; only the tops of chains look for their parent. Each node
gets an arc that enters it and one that leaves it. The arcs are a linked list,
ranked by contraction (`ordered.list_sums`); what a subtree holds is the
difference of the prefix sums at the two arcs of its top.

Prefixes are told apart by 124 bits: a sum over the turns of a hash of place, role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from deedflow.llm.common import staged, word_count
from deedflow.llm.ordered import MASK, list_sums, scanned

# Conversations that share their first turns with the one whose id is the last multiple of this.
FAMILY = 20
# Remainders of a checksum say how many turns are shared.
SHARES = 4
NOBODY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Turns as `conv`, `_pos` from 1, two hashes of role and text, and `words` of the text.

    Order: turn, NULL first, then the SHA-256 of role and text. NULL role or text is
    empty. Rows without `conv_id` belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").isNotNull().cast("long").alias("_set"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("_turn"),
        digest.alias("_digest"), word_count(text).alias("words"),
    ).selectExpr(
        "conv", "_set", "_turn", "words",
        "CAST(conv(substring(_digest, 1, 15), 16, 10) AS long) AS a", "CAST(conv(substring(_digest, 16, 15), 16, 10) AS long) AS b")
    return scanned(turns, "conv", ["_set", "_turn", "a", "b"], "turns").select("conv", "_pos", "a", "b", "words")


def rebuilt(turns: DataFrame, family: int = FAMILY, shares: int = SHARES) -> DataFrame:
    """Every prefix of every rebuilt conversation: `conv`, `depth`, its key (`k1`, `k2`), the key before, `words`.

    A conversation takes the first h turns of the first of its family, all if there are fewer, then its own after
    the first h; h is a checksum of its id. Depth 0 is the empty prefix.
    """
    convs = turns.filter("_pos = 1").selectExpr(
        "conv", f"conv - conv % {family} AS first", f"crc32(CAST(conv AS string)) % {shares} AS h")
    # At most `shares` - 1 turns of a conversation, and `family` conversations that take them.
    lent = turns.filter(f"_pos < {shares}").selectExpr("conv AS first", "_pos", "a", "b", "words")
    taken = staged(convs.join(lent, "first").filter("_pos <= h").select("conv", "_pos", "a", "b", "words"), "taken-turns")
    shifts = staged(
        convs.join(taken.groupBy("conv").agg(F.count(F.lit(1)).alias("k")), "conv", "left")
        .selectExpr("conv", "h - coalesce(k, 0) AS shift").filter("shift > 0"), "shifts")
    own = turns.filter(f"_pos > crc32(CAST(conv AS string)) % {shares}").join(shifts, "conv", "left").selectExpr(
        "conv", "_pos - coalesce(shift, 0) AS depth", "a", "b", "words")
    hashed = taken.withColumnRenamed("_pos", "depth").unionByName(own).selectExpr(
        "conv", "depth", f"xxhash64(depth, a, b) & {MASK}L AS h1", f"xxhash64(b, depth, a) & {MASK}L AS h2", "words")
    roots = convs.selectExpr("conv", "0L AS depth", "0L AS h1", "0L AS h2", "0L AS words")
    both = hashed.unionByName(roots).selectExpr("*", "h1 AS k1", "h2 AS k2")
    return scanned(both, "conv", ["depth"], "prefixes", sums=["k1", "k2"]).selectExpr(
        "conv", "depth", "k1", "k2", f"(k1 - h1) & {MASK}L AS p1", f"(k2 - h2) & {MASK}L AS p2", "words")


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, which come in order; only the running hash is kept."""
    names = ["depth", "k1", "k2", "ends"]
    node, digest = None, None
    for batch in batches:
        found = []
        for *key, conv in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            if key == node:
                digest.update(b",%d" % conv)
                continue
            if node:
                found.append((*node, digest.hexdigest()))
            node, digest = key, hashlib.sha256(b"%d" % conv)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*found)], names)
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([value]) for value in (*node, digest.hexdigest())], names)


def end_hashes(prefixes: DataFrame) -> DataFrame:
    """Per node where conversations end, the hash of their ids.

    A hash runs over its ids one after the other, so the ids of one node pass through one task; they
    are sorted on disk and streamed.
    """
    ends = prefixes.groupBy("conv").agg(F.max(F.struct("depth", "k1", "k2")).alias("end")).select("end.*", "conv")
    key = ["depth", "k1", "k2"]
    return ends.repartition(*key).sortWithinPartitions(*key, "conv").mapInArrow(
        _end_hashes, "depth long, k1 long, k2 long, ends string")


def trie(conversations: DataFrame, family: int = FAMILY, shares: int = SHARES) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; no conversations give no nodes.

    `conv_id` (smallest member), `depth`, `parent_conv_id` (NULL at the root), `n_convs`
    (members), `n_children`, `n_leaves` (childless nodes of the subtree), `saved_tokens`
    (words that members after the first need not store or compute again, over the subtree), `ends_sha256` (of the
    members that end here). Repeated rows are turns of their own. Other columns are not looked at.
    """
    prefixes = rebuilt(ordered_turns(conversations), family, shares)
    nodes = prefixes.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("c"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = scanned(nodes, "c", ["depth"], "nodes").withColumnRenamed("_at", "k")
    root = nodes.filter("depth = 0").select("c").first()
    root = root["c"] if root else None
    # The top of a chain is the only one with its parent elsewhere. Both sides are written, so a hot parent is split.
    tops = nodes.filter("_pos = 1 AND depth > 1").selectExpr("k", "depth - 1 AS depth", "p1 AS k1", "p2 AS k2")
    parents = nodes.selectExpr("depth", "k1", "k2", "k AS up", "c AS up_conv")
    links = tops.join(parents, ["depth", "k1", "k2"]).select("k", "up", "up_conv").unionByName(
        nodes.filter("_pos = 1 AND depth = 1").select("k", F.lit(0).cast("long").alias("up"), F.lit(root).cast("long").alias("up_conv"))
    ).unionByName(nodes.filter("_pos > 1").selectExpr("k", "k - 1 AS up", "c AS up_conv"))
    # In descending order the row before is the next sibling.
    links = scanned(links.withColumn("down", -F.col("k")), "up", ["down"], "links", lag="k")
    kids = links.groupBy("up").agg(F.min("k").alias("kid"), F.count(F.lit(1)).alias("n_children"))
    nodes = staged(
        nodes.join(links.select("k", "up", "up_conv", F.col("_lag").alias("sibling")), "k", "left")
        .join(kids.withColumnRenamed("up", "k"), "k", "left")
        .selectExpr("k", "c", "depth", "k1", "k2", "up", "up_conv", "sibling", "kid", "n_convs",
                    "coalesce(n_children, 0L) AS n_children", "(n_convs - 1) * words AS saved"), "linked-nodes")
    arcs = nodes.selectExpr("inline(array("
        "struct(2 * k AS id, coalesce(2 * kid, 2 * k + 1) AS next, if(kid IS NULL, 1L, 0L) AS w1, saved AS w2),"
        "struct(2 * k + 1 AS id, coalesce(2 * sibling, 2 * up + 1, -1L) AS next, 0L AS w1, 0L AS w2)))")
    sums = list_sums(arcs).groupBy(F.expr("id div 2").alias("k")).agg(*[
        F.expr(f"sum(if(id % 2 = 1, {name}, -{name})) AS {alias}")
        for name, alias in (("before1", "n_leaves"), ("before2", "saved_tokens"))])
    return nodes.join(sums, "k").join(end_hashes(prefixes), ["depth", "k1", "k2"], "left").select(
        F.col("c").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))
