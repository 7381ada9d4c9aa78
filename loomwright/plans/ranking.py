"""Ranking, deduplication, packing and chunking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.rules import text_of
from loomwright.operators import chunking, quality, windows
from loomwright.session import table


def topk_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    return windows.top_per_key(line, ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey")], 3, "rank")


def topk_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


def numeric_aware_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.regexp_extract("s_name", "([0-9]+)$", 1).try_cast("long")
    return table(spark, sf_dir, "supplier").orderBy(key.asc_nulls_last(), "s_name").limit(10).select("s_name", key.alias("number"))


def prefer_valid_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    keyed = docs.select("doc_id", F.md5(text_of("text")).alias("h"), F.coalesce("quality", F.lit(-1)).alias("q"))
    return windows.prefer(keyed, ["h"], [F.desc("q"), F.col("doc_id")]).select("doc_id", "q")


def first_seen_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5(text_of("text")).alias("h"))
    return windows.prefer(keyed, ["h"], [F.col("doc_id")]).select("doc_id", "source")


def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return windows.prefer(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with new prices for every third one, and some new keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    new = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit(1.0).alias("price")).unionByName(orders.where("o_orderkey % 5 = 0").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "price"))
    return windows.upsert(orders, new, ["o_orderkey"])


def preferred_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each user the entry that is active (a purchase), else the one with the largest id."""
    events = table(spark, sf_dir, "events")
    best = F.max(F.struct((F.col("event_type") == "purchase").alias("active"), "event_id", "event_type"))
    return events.groupBy("user_id").agg(best.alias("b")).select("user_id", "b.event_id", "b.event_type")


def question_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = windows.fixed_parts(table(spark, sf_dir, "benchmark").select("item_id"), ["item_id"], 1)
    return numbered.select("item_id", F.concat(F.lit("Q"), F.lpad((F.col("part") + 1).cast("string"), 3, "0")).alias("question_id"))


def pack_parts_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.fixed_parts(table(spark, sf_dir, "documents").select("source", "doc_id"), ["doc_id"], 8, ["source"])


def pack_parts_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.even_parts(table(spark, sf_dir, "documents").select("source", "doc_id"), ["doc_id"], 3, ["source"])


def pack_parts_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return windows.greedy_parts(docs, ["source"], "doc_id", F.octet_length(text_of("text")).cast("long"), 8, 20000)


def payload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and characters of each source, and whether it must be split for upload."""
    out = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length(text_of("text"))).alias("bytes"), F.sum(F.length(text_of("text"))).alias("chars"))
    return out.withColumn("split", (F.col("bytes") >= 350 * 1024) | (F.col("docs") > 8) | (F.col("bytes") > 220 * 1024))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 1200, "\n")


def chunk_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk_index", "chunk_count", F.length("chunk").alias("chars"), F.md5("chunk").alias("chunk"))


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("chunk")
    return _chunks(spark, sf_dir).agg(F.count(F.lit(1)).alias("chunks"), F.min(n).alias("least"), F.max(n).alias("most"), F.sum(n).alias("chars"))


def value_counts_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.value_counts(table(spark, sf_dir, "documents"), "lang", 3)


_CHUNKS = r"""
WITH RECURSIVE p AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM documents
), s AS (
  SELECT doc_id, t, ps, 1 AS i, []::VARCHAR[] AS outs, '' AS cur FROM p
  UNION ALL
  SELECT doc_id, t, ps, i + 1,
    CASE WHEN cur = '' OR length(cur) + length(r) + 1 <= 1200 THEN list_concat(outs, sl) ELSE list_append(list_concat(outs, sl), cur) END,
    CASE WHEN cur = '' THEN r WHEN length(cur) + length(r) + 1 <= 1200 THEN cur || chr(10) || r ELSE r END
  FROM (SELECT *, list_transform(range(0, (length(ps[i]) - 1) // 1200), lambda k: ps[i][k * 1200 + 1 : k * 1200 + 1200]) AS sl, ps[i][((length(ps[i]) - 1) // 1200) * 1200 + 1 :] AS r FROM s WHERE i <= len(ps))
), f AS (
  SELECT doc_id, CASE WHEN len(ps) = 0 THEN [t] WHEN cur = '' THEN outs ELSE list_append(outs, cur) END AS cs FROM s WHERE i = len(ps) + 1
), c AS (SELECT doc_id, CAST(len(cs) AS INT) AS chunk_count, unnest(cs) AS chunk, CAST(generate_subscripts(cs, 1) - 1 AS INT) AS chunk_index FROM f)
"""
_PACK = """
WITH RECURSIVE d AS (SELECT source, doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
r AS (
  SELECT source, doc_id, size, i, 0 AS part, 1 AS n, size AS held FROM d WHERE i = 1
  UNION ALL
  SELECT d.source, d.doc_id, d.size, d.i, CASE WHEN r.n + 1 > 8 OR r.held + d.size > 20000 THEN r.part + 1 ELSE r.part END, CASE WHEN r.n + 1 > 8 OR r.held + d.size > 20000 THEN 1 ELSE r.n + 1 END,
    CASE WHEN r.n + 1 > 8 OR r.held + d.size > 20000 THEN d.size ELSE r.held + d.size END FROM r JOIN d ON d.source = r.source AND d.i = r.i + 1
)
SELECT source, doc_id, size, part FROM r
"""

QUERIES = {
    "topk_per_key": topk_per_key, "topk_global": topk_global, "numeric_aware_sort": numeric_aware_sort, "prefer_valid_dedupe": prefer_valid_dedupe, "first_seen_dedupe": first_seen_dedupe, "latest_wins_upsert": latest_wins,
    "keyed_upsert": keyed_upsert, "preferred_active": preferred_active, "question_numbers": question_numbers, "pack_parts_fixed": pack_parts_fixed, "pack_parts_ntile": pack_parts_ntile, "pack_parts_size": pack_parts_size,
    "payload_sizes": payload_sizes, "chunk_paragraphs": chunk_paragraphs, "chunk_stats": chunk_stats, "value_counts_topn": value_counts_topn,
}

ORACLE_SQL = {
    "topk_per_key": "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS INT) AS rank FROM lineitem QUALIFY rank <= 3",
    "topk_global": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "numeric_aware_sort": "SELECT s_name, TRY_CAST(regexp_extract(s_name, '([0-9]+)$', 1) AS BIGINT) AS number FROM supplier ORDER BY number NULLS LAST, s_name LIMIT 10",
    "prefer_valid_dedupe": "SELECT doc_id, q FROM (SELECT d.doc_id, coalesce(quality, -1) AS q, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY coalesce(quality, -1) DESC, d.doc_id) AS r FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) WHERE r = 1",
    "first_seen_dedupe": "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS r FROM documents) WHERE r = 1",
    "latest_wins_upsert": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "keyed_upsert": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1.0::DOUBLE ELSE o_totalprice END AS price FROM orders UNION ALL SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderkey % 5 = 0""",
    "preferred_active": "SELECT user_id, b.event_id AS event_id, b.event_type AS event_type FROM (SELECT user_id, max(struct_pack(active := event_type = 'purchase', event_id := event_id, event_type := event_type)) AS b FROM events GROUP BY 1)",
    "question_numbers": "SELECT item_id, 'Q' || lpad(CAST(row_number() OVER (ORDER BY item_id) AS VARCHAR), 3, '0') AS question_id FROM benchmark",
    "pack_parts_fixed": "SELECT source, doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS INT) AS part FROM documents",
    "pack_parts_ntile": "SELECT source, doc_id, CAST(ntile(3) OVER (PARTITION BY source ORDER BY doc_id) AS INT) AS part FROM documents",
    "pack_parts_size": _PACK,
    "payload_sizes": "SELECT source, count(*) AS docs, CAST(sum(octet_length(encode(coalesce(text, '')))) AS BIGINT) AS bytes, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars, bytes >= 358400 OR docs > 8 OR bytes > 225280 AS split FROM documents GROUP BY 1",
    "chunk_paragraphs": _CHUNKS + "SELECT doc_id, chunk_index, chunk_count, CAST(length(chunk) AS INT) AS chars, md5(chunk) AS chunk FROM c",
    "chunk_stats": _CHUNKS + "SELECT count(*) AS chunks, CAST(min(length(chunk)) AS INT) AS least, CAST(max(length(chunk)) AS INT) AS most, CAST(sum(length(chunk)) AS BIGINT) AS chars FROM c",
    "value_counts_topn": "SELECT lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, lang LIMIT 3",
}
