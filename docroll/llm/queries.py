"""The registered queries of this subpackage: ``opN_<name>(spark, data_dir)``
applies operator N, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroll.llm import langid, quality
from docroll.llm.ann import nearest
from docroll.llm.conv_repair import damaged, repair_report
from docroll.llm.decontam import contaminations
from docroll.llm.filter_audit import audit, order_steps
from docroll.llm.jaccard_join import jaccard_components
from docroll.llm.line_dedup import line_digests
from docroll.llm.mixing import copies
from docroll.llm.packing import pack
from docroll.llm.sample import held_out
from docroll.llm.sharding import shard_rows
from docroll.llm.ship import ship
from docroll.llm.suffix_dedup import suffix_digests
from docroll.llm.unit_dedup import PASSAGE, unit_digests

#: Documents that must hold a line before it counts as boilerplate.
COMMON_LINE = 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def read(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def real_id(column: str = "doc_key"):
    """The id behind an operator's key (the smallest long stands for a null)."""
    return F.when(F.col(column) != F.lit(-(1 << 63)), F.col(column))


#: Queries of op1: ids divisible by this.
ASKED = 20


@register
def op1_nn_descent(spark: SparkSession, data_dir: str) -> DataFrame:
    return nearest(read(spark, data_dir, "embeddings"), lambda i: i % ASKED == 0, k=20)


@register
def op2_decontamination(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every benchmark passage found in a document, with its place and edits."""
    got = contaminations(read(spark, data_dir, "documents"), read(spark, data_dir, "benchmark"))
    return got.select(real_id().alias("doc_id"), real_id("item_key").alias("item_id"), "edits", "budget", "item_chars", "start", "end")


@register
def op3_language_id(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = read(spark, data_dir, "documents")
    got = langid.identify(docs.select("doc_id", "text"), langid.fit(docs, ~held_out()))
    return got.select("doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score")


@register
def op4_source_mix(spark: SparkSession, data_dir: str) -> DataFrame:
    got = copies(read(spark, data_dir, "documents"))
    return got.select(real_id().alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@register
def op5_suffix_array_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    got = suffix_digests(read(spark, data_dir, "documents"))
    return got.select(real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op6_line_hash_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    """Repeated lines of any length, cut but for the earliest, and passages of over 50 words
    that an earlier document holds, wherever they stand in their lines: how many of each, and the bytes of both."""
    got = unit_digests(read(spark, data_dir, "documents"), min_words=1, passage=PASSAGE)
    return got.select(real_id().alias("doc_id"), "n_passages_removed", "n_units", "n_units_removed", "n_removed", "kept_sha256", "removed")


@register
def op7_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = read(spark, data_dir, "documents")
    model = quality.fit(docs, read(spark, data_dir, "labels"), ~held_out())
    got = quality.score_documents(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register
def op8_ngram_jaccard_join(spark: SparkSession, data_dir: str) -> DataFrame:
    got = jaccard_components(read(spark, data_dir, "documents"))
    return got.select(real_id().alias("doc_id"), "n_shingles", real_id("component_id").alias("component_id"), "copies", "n_links")


@register
def op9_bounded_ring_shards(spark: SparkSession, data_dir: str) -> DataFrame:
    got = shard_rows(read(spark, data_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op10_line_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    got = line_digests(read(spark, data_dir, "documents"), COMMON_LINE)
    return got.select(real_id().alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


# DuckDB: A-Z lowered by translate, since lower() folds all of Unicode.
_LINES = r"""
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents)"""

ORACLE["op10_line_dedup"] = rf"""
WITH {_LINES.strip()},
keyed AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= {COMMON_LINE})
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY k.doc_id
"""


@register
def op11_conversation_repair(spark: SparkSession, data_dir: str) -> DataFrame:
    return repair_report(damaged(read(spark, data_dir, "conversations")), present="present")


@register
def op12_filter_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    return order_steps(audit(read(spark, data_dir, "documents"), read(spark, data_dir, "labels")))


ORACLE["op12_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
docs AS (
  SELECT t.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(t.words) < 200 THEN 1 ELSE 0 END AS fa,
         CASE WHEN 100 * len(list_distinct(t.words)) < 50 * len(t.words) THEN 1 ELSE 0 END AS fb,
         CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 3 * length(t.text) THEN 1 ELSE 0 END AS fc,
         CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 1 ELSE 0 END AS fd,
         CASE WHEN t.doc_id > f.first THEN 1 ELSE 0 END AS fe
  FROM texts t JOIN firsts f ON t.text = f.text LEFT JOIN marks m ON m.doc_id = t.doc_id),
masks AS (
  SELECT part, fa + 2 * fb + 4 * fc + 8 * fd + 16 * fe AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM docs GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT m.part, s.filter_order, s.step, s.bit,
         sum(CASE WHEN m.mask & (s.earlier | s.bit) = 0 THEN m.n ELSE 0 END) AS kept,
         sum(CASE WHEN m.mask & s.earlier = 0 AND m.mask & s.bit <> 0 THEN m.n ELSE 0 END) AS removed,
         sum(CASE WHEN m.mask & s.earlier <> 0 AND m.mask & s.bit <> 0 THEN m.n ELSE 0 END) AS redundant,
         sum(CASE WHEN m.mask = s.bit THEN m.n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN m.mask & s.earlier = 0 AND m.mask & s.bit <> 0 THEN m.good ELSE 0 END) AS good_lost,
         sum(CASE WHEN m.mask & s.earlier = 0 AND m.mask & s.bit <> 0 THEN m.toxic ELSE 0 END) AS toxic_lost
  FROM masks m, steps s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


#: The tokenizer's file, at the same path on every executor.
TOKENIZER = "byte_bpe_50k.json"


@register
def op13_linear_grouping_pack(spark: SparkSession, data_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, data_dir, "documents"), public_tokenizers.path(TOKENIZER))
