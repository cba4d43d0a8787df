"""Mixing of sources to target weights by pivotal dependent rounding.

A source's target over its size gives each of its documents a wanted number of
copies. The whole part is granted; the fraction is rounded by pivotal steps: two
documents meet, and one takes words from the other, at random but without
bias, until one of the two fractions is 0 or 1. The words of the source are
kept by each step, so its total misses the target by one document at most.

Documents of a source fall into blocks of about `FAN` by a hash. A block is
walked through by a higher-order function and leaves one open document, the
open ones of `FAN` blocks meet in the next level, and so on, until each source has
one block. The first level holds almost all the work. Every level is written to the
shared folder, so that no plan holds those below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from deedflow.llm.common import SALTS, masked, repeated, staged, text_key, unit, unmasked, word_count

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = 7001
FAN = 256
ITEM = ("_none", "_name", "doc_id", "size", "_text", "_copies")


def source_targets(sources: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Adds `target` to one row per source (`_none`, `_name`, `source_size`).

    Weights repeat over the sources in the order of their names, NULL last.
    Shares above `limit` times the source's size stop there and the rest is
    shared anew. Sorted by limit over weight, the sources that stop are a
    prefix, so two running sums settle all rounds of this at once.
    """
    listed = ", ".join(f"{float(w)!r}D" for w in weights)
    return sources.withColumn("_place", F.row_number().over(Window.orderBy("_none", "_name"))).selectExpr(
        "*", f"element_at(array({listed}), CAST((_place - 1) % {len(weights)} + 1 AS int)) AS _weight",
        f"CAST({limit} * source_size AS double) AS _cap", "CAST(sum(source_size) OVER () AS double) AS _whole",
    ).selectExpr(
        "*", "coalesce(sum(_cap) OVER (ORDER BY _cap / _weight, _place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS _stopped",
        "sum(_weight) OVER (ORDER BY _cap / _weight, _place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _open",
    ).selectExpr("*", "(_whole - _stopped) / _open AS _level").selectExpr(
        "*", "max(if(_cap / _weight > _level, _level, NULL)) OVER () AS _final"
    ).selectExpr("_none", "_name", "source_size", "_documents", "least(_cap, coalesce(_weight * _final, _cap)) AS target")


# One pivotal step: `s` holds the open document (place i, fraction p, size a) and
# the places rounded up so far; `x` is the next document with its random number u.
STEP = """
CASE WHEN s.i < 0 THEN named_struct('i', x.i, 'p', x.p, 'a', x.a, 'ups', s.ups)
WHEN x.u * (least(s.a * (1 - s.p), x.a * x.p) + least(s.a * s.p, x.a * (1 - x.p))) < least(s.a * s.p, x.a * (1 - x.p)) THEN
  CASE WHEN s.a * (1 - s.p) < x.a * x.p
  THEN named_struct('i', x.i, 'p', x.p - s.a * (1 - s.p) / x.a, 'a', x.a, 'ups', concat(s.ups, array(s.i)))
  WHEN s.a * (1 - s.p) > x.a * x.p
  THEN named_struct('i', s.i, 'p', s.p + x.a * x.p / s.a, 'a', s.a, 'ups', s.ups)
  ELSE named_struct('i', -1, 'p', 0D, 'a', 0D, 'ups', concat(s.ups, array(s.i))) END
ELSE
  CASE WHEN s.a * s.p < x.a * (1 - x.p)
  THEN named_struct('i', x.i, 'p', x.p + s.a * s.p / x.a, 'a', x.a, 'ups', s.ups)
  WHEN s.a * s.p > x.a * (1 - x.p)
  THEN named_struct('i', s.i, 'p', s.p - x.a * (1 - x.p) / s.a, 'a', s.a, 'ups', concat(s.ups, array(x.i)))
  ELSE named_struct('i', -1, 'p', 0D, 'a', 0D, 'ups', concat(s.ups, array(x.i))) END
END"""


def _walked(items: DataFrame, level: int, seed: int) -> DataFrame:
    """One row per block: its documents, the places rounded up, the open one."""
    fields = ", ".join(ITEM)
    chance = unit(F.xxhash64(F.lit(seed + level), "doc_id", "size", "_text"))
    return items.withColumn("_u", chance).groupBy("_none", "_name", "_block").agg(
        F.expr(f"array_sort(collect_list(struct(_u, {fields}, _p, _mass, _granted))) AS _items")
    ).withColumn("_done", F.expr(
        "aggregate(transform(_items, (d, k) -> named_struct('i', k, 'u', d._u, 'p', d._p, 'a', d._mass)),"
        f" named_struct('i', -1, 'p', 0D, 'a', 0D, 'ups', CAST(array() AS array<int>)), (s, x) -> {STEP})"
    ))


def _opened(walked: DataFrame) -> DataFrame:
    """The open documents, for the next level."""
    fields = [f"_items[_done.i].{name} AS {name}" for name in (*ITEM, "_granted", "_mass")]
    return walked.filter("_done.i >= 0").selectExpr(*fields, "_done.p AS _p", f"_block div {FAN} AS _block")


def _settled(walked: DataFrame) -> DataFrame:
    rows = walked.selectExpr("posexplode(_items) AS (_place, _item)", "_done").filter("_place <> _done.i")
    fields = [f"_item.{name} AS {name}" for name in (*ITEM, "_granted")]
    return rows.selectExpr(*fields, "if(array_contains(_done.ups, _place), 1L, 0L) AS _up")


def copies(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """How often the mix takes each document.

    One row per distinct (`source`, `doc_id`, `size`, text): `_text` is a hash
    of the text, `_copies` the rows that share it, `_taken` the copies of all of
    them, with `source_size` and `target` of the source. No document is taken
    more than `limit` times. A document without words takes no part in the
    rounding and gets the whole part of its copies. NULL sources form one
    source; NULL ids are ids like others; no rows give no rows.
    """
    groups = docs.select(
        *text_key("source"), "doc_id", word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("_text"),
    ).groupBy("_none", "_name", "doc_id", "size", "_text").agg(F.count(F.lit(1)).alias("_copies"))
    groups = staged(groups, "mix-documents")
    sources = groups.groupBy("_none", "_name").agg(
        F.expr("sum(size * _copies) AS source_size"), F.count(F.lit(1)).alias("_documents")
    )
    targets = source_targets(sources, weights, limit).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salt = F.pmod(F.xxhash64("doc_id", "_text"), F.lit(SALTS)).cast("int")
    wanted = groups.withColumn("_salt", salt).join(targets, ["_none", "_name", "_salt"]).drop("_salt")
    wanted = wanted.withColumn(
        "_wanted", F.expr("if(source_size = 0, 0D, _copies * (target / source_size))")
    ).withColumn("_granted", F.expr("CAST(floor(_wanted + 1e-9) AS long)")).withColumn(
        "_p", F.expr("greatest(_wanted - _granted, 0D)")
    ).withColumn("_mass", F.col("size").cast("double")).withColumn(
        "_block", F.expr(f"pmod(xxhash64({seed}, doc_id, _text, size), (_documents + {FAN - 1}) div {FAN})")
    )
    wanted = staged(wanted, "mix-wanted")
    fixed = wanted.filter("_p <= 1e-9 OR size = 0").selectExpr(*ITEM, "_granted", "0L AS _up")
    walked = staged(_walked(wanted.filter("_p > 1e-9 AND size > 0"), 0, seed), "mix-level")
    decided, level = fixed.unionByName(_settled(walked)), 0
    # Of the source with the most blocks.
    last_block = wanted.agg(F.coalesce(F.max("_block"), F.lit(0))).first()[0]
    while last_block > 0:
        level, last_block = level + 1, last_block // FAN
        walked = staged(_walked(_opened(walked), level, seed), "mix-level")
        decided = decided.unionByName(_settled(walked))
    last = _opened(walked).withColumn(
        "_up", (unit(F.xxhash64(F.lit(seed + 99), "doc_id", "size", "_text")) < F.col("_p")).cast("long")
    ).select(*ITEM, "_granted", "_up")
    taken = decided.unionByName(last).withColumn("_salt", salt)
    return taken.join(targets.drop("_documents"), ["_none", "_name", "_salt"]).selectExpr(
        "if(_none = 1, NULL, _name) AS source", "doc_id", "size", "_text", "_copies", "_granted + _up AS _taken",
        "source_size", "target",
    )


def taken_words(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """One row per document: `doc_id`, `source`, `size`, `source_size`, `target`, `copies`, `taken` words."""
    rows = repeated(copies(docs, weights, limit, seed), "_copies", "_copy")
    share = F.expr("_taken div _copies + if(_copy < _taken % _copies, 1L, 0L)")
    return rows.withColumn("copies", share).selectExpr(
        "doc_id", "source", "size", "source_size", "target", "copies", "copies * size AS taken"
    )


def mixed(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, with all their columns."""
    keys = ["_k_none", "_k_name", "_k_null", "_k_id", "_k_size", "_k_text"]

    def keyed(df, source, doc_id, size, text):
        return df.select(
            "*", F.col(source).isNull().alias("_k_none"), F.coalesce(source, F.lit("")).alias("_k_name"),
            F.col(doc_id).isNull().alias("_k_null"), F.coalesce(doc_id, F.lit(0)).alias("_k_id"),
            size.alias("_k_size"), text.alias("_k_text"),
        )

    counts = keyed(copies(docs, weights, limit, seed), "source", "doc_id", F.col("size"), F.col("_text"))
    rows, names = masked(docs)
    text = F.col(names["text"])
    rows = keyed(rows, names["source"], names["doc_id"], word_count(text), F.xxhash64(text))
    # Equal rows are numbered in any order, as any of them may be taken.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    joined = rows.join(counts.select(*keys, "_copies", "_taken").filter("_taken > 0"), keys)
    joined = joined.withColumn("_number", number).withColumn(
        "_times", F.expr("_taken div _copies + if(_number <= _taken % _copies, 1L, 0L)")
    ).filter("_times > 0")
    return unmasked(repeated(joined, "_times", "_time"), names)
