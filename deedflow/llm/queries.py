"""The corpus operators as queries over whole tables, with SQL counterparts where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from deedflow.llm import (
    conversation_trie, decontamination, filter_audit, language_model, license_scan, line_dedup, mixing, neighbours, sharding,
    simhash, substring_dedup, token_counts, toxicity,
)
from deedflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_lm_scores(spark, sf_dir):
    return language_model.scores(table(spark, sf_dir, "documents"))


@query
def op2_pivotal_mix(spark, sf_dir):
    mix = mixing.taken_words(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op3_simhash(spark, sf_dir):
    return simhash.clusters(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query
def op4_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_line_dedup(spark, sf_dir):
    return line_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last AS dropped
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op8_interleave(spark, sf_dir):
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


@query
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLES["op6_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
starts AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 33, 1))) AS s FROM docs),
windows AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY array_to_string(words[s:s + 34], ' ')) AS n FROM starts),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS place FROM windows WHERE n > 1),
lost AS (
  SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(l.places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN l.places IS NULL THEN d.words
    ELSE list_filter(d.words, lambda w, i: NOT list_contains(l.places, i)) END, ' ')) AS kept_sha256
FROM docs d LEFT JOIN lost l USING (doc_id)
"""


@query
def op7_toxicity(spark, sf_dir):
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", F.coalesce(toxicity.fold(toxicity.FOLDS) == 0, F.lit(False)).alias("held_out"), "score", "predicted", "flagged"
    )


@query
def op9_neighbours(spark, sf_dir):
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"))


@query
def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
firsts AS (
  SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
marks AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails
  FROM docs JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
grouped AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
marked AS (
  SELECT g.*, s.*, contains(fails, own) AS hit,
    len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AND fails <> '' AND earlier <> '' AS gone
  FROM grouped g, steps s),
shares AS (
  SELECT part, own, CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS shapley FROM marked GROUP BY part, own)
SELECT part, filter_order, step,
  CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  any_value(shapley) AS shapley
FROM marked JOIN shares USING (part, own) GROUP BY part, filter_order, step
"""


@query
def op12_license_scan(spark, sf_dir):
    return license_scan.licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _notice_rows() -> str:
    """The notices as rows of SQL: kind, label, words."""
    rows = []
    for kind, notices in enumerate((license_scan.LINES, license_scan.PASSAGES)):
        for label, texts in notices.items():
            for text in texts:
                words = ", ".join(f"'{word}'" for word in sorted(set(text.split())))
                rows.append(f"({kind}, '{label}', [{words}])")
    return ",\n  ".join(rows)


# Every block is set against every notice here, without filters.
ORACLES["op12_license_scan"] = rf"""
WITH notices(kind, label, own) AS (VALUES
  {_notice_rows()}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
worded AS (
  SELECT *, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs),
base AS (
  SELECT *, list_filter(range(1, len(w) + 1), lambda i: w[i:i + 1] = ['cc', 'by'] OR w[i:i + 2] = ['general', 'public', 'license']
    OR w[i:i + 2] = ['all', 'rights', 'reserved']) AS places,
    list_filter([
      CASE WHEN contains(' ' || array_to_string(w, ' ') || ' ', ' cc by ') THEN 'cc-by' END,
      CASE WHEN contains(' ' || array_to_string(w, ' ') || ' ', ' general public license ') THEN 'gpl' END,
      CASE WHEN contains(' ' || array_to_string(w, ' ') || ' ', ' all rights reserved ') THEN 'reserved' END],
      lambda l: l IS NOT NULL) AS labels
  FROM worded),
pieces AS (
  SELECT r, 0 AS kind, {license_scan.LINE_WORDS} AS size, regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT r, unnest(string_split(low, chr(10))) AS line FROM docs)
  UNION ALL
  SELECT r, 1, {license_scan.PASSAGE_WORDS}, w FROM worded),
blocks AS (
  SELECT r, kind, list_distinct(w[s:s + size - 1]) AS have
  FROM (SELECT *, unnest(range(1, greatest(len(w) - size // 2, 1) + 1, size // 2)) AS s FROM pieces)),
found AS (
  SELECT r, list(DISTINCT label) AS labels, max(len(list_intersect(own, have)) / len(own)) AS found
  FROM blocks b JOIN notices n ON b.kind = n.kind AND len(list_intersect(own, have)) >= ceil(round({license_scan.THRESHOLD} * len(own), 9))
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, places[1] - 1 AS first_word,
  places[-1] - 1 AS last_word, array_to_string(list_sort(b.labels), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(b.labels, coalesce(f.labels, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(found, 0) END AS score
FROM base b LEFT JOIN found f USING (r)
"""


@query
def op13_conversation_trie(spark, sf_dir):
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


# The checksum of the decimal id is worked out byte by byte; its table is built first.
ORACLES["op13_conversation_trie"] = r"""
WITH RECURSIVE shifted AS (
  SELECT i, 0 AS k, i AS v FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM shifted WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM shifted WHERE k = 8),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      substr(sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 20 AS first,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda s, b: xor(s // 256, t[1 + xor(s % 256, b)])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
joined AS (
  SELECT v.c, 0 AS own, pos, role, text FROM convs v JOIN turns t ON t.c = v.first AND pos <= h
  UNION ALL
  SELECT v.c, 1 AS own, pos, role, text FROM convs v JOIN turns t ON t.c = v.c AND pos > h),
placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, role, text FROM joined),
prefixes AS (
  SELECT c, d, list(sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text)) OVER (PARTITION BY c ORDER BY d) AS key,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM placed
  UNION ALL
  SELECT c, 0, CAST([] AS VARCHAR[]), 0 FROM convs),
members AS (
  SELECT *, min(c) OVER (PARTITION BY d, key) AS node, max(d) OVER (PARTITION BY c) AS length FROM prefixes),
nodes AS (
  SELECT node, d, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE length = d), '')) AS ends_sha256
  FROM members GROUP BY node, d),
parents AS (
  SELECT n.node, n.d, m.node AS parent FROM nodes n JOIN members m ON m.c = n.node AND m.d = n.d - 1),
kids AS (
  SELECT parent AS node, d - 1 AS d, count(*) AS n FROM parents GROUP BY parent, d),
costs AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, (n_convs - 1) * words AS saved
  FROM nodes n LEFT JOIN kids k USING (node, d)),
subtrees AS (
  SELECT m.node, m.d, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM costs w JOIN members m ON m.c = w.node AND m.d <= w.d GROUP BY m.node, m.d)
SELECT c.node AS conv_id, c.d AS depth, p.parent AS parent_conv_id, n_convs, n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM costs c JOIN subtrees USING (node, d) LEFT JOIN parents p USING (node, d)
"""
