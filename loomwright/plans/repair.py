"""Queries over responses and payloads of any depth and damage, made from the documents' own values."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.durable import shared_folder
from loomwright.functions.rules import text_of
from loomwright.operators import answers, payload_repair
from loomwright.plans.support import made, made_sql
from loomwright.session import table
from loomwright.sources import committed

#: Responses that cite at up to fourteen levels: lists in lists, keys in several cases, blanks, numbers and repeats.
RESPONSES = {
    "doc_id": "doc_id",
    "raw": """CASE WHEN doc_id % 11 = 0 THEN '{"sources": [' ELSE concat('{"z": ["sources"], "Evidence": ["top ', doc_id % 4, '", "top 1"], "answer": ', repeat('{"data": {"items": [1, ', CAST(doc_id % 8 AS INT)),
      '{"id": ', doc_id, ', "Sources": [{"title": "', source, '", "url": "u', doc_id % 5, '", "id": ', doc_id, ', "repo": null}, " ', lang, ' ", "", 7, {"context": ["deep ', doc_id % 3, '", {"name": "n", "x": {"citations": ["far"]}}]}]}',
      repeat(', "x"]}}', CAST(doc_id % 8 AS INT)), ', "documents": ["', lang, '", {"label": "L', doc_id % 2, '"}], "sources": {"title": "no list"}}') END""",
}


def nested_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, "documents", RESPONSES).select("doc_id", F.array_join(answers.answer_sources(F.col("raw")), "; ").alias("sources"))


NESTED_SOURCES = f"""
WITH RECURSIVE i AS ({made_sql("documents", RESPONSES)}), w AS (
  SELECT doc_id, raw::JSON AS node, CAST([] AS BIGINT[]) AS place, false AS listed FROM i WHERE json_valid(raw)
  UNION ALL
  SELECT doc_id, child, list_append(place, nth), cites FROM (
    SELECT doc_id, place, nth, lower(key) IN ('sources', 'documents', 'citations', 'evidence', 'context') AND json_type(json_extract(node, '$."' || key || '"')) = 'ARRAY' AS cites, json_extract(node, '$."' || key || '"') AS child
    FROM (SELECT doc_id, node, place, unnest(json_keys(node)) AS key, unnest(range(len(json_keys(node)))) AS nth FROM w WHERE json_type(node) = 'OBJECT')
    UNION ALL
    SELECT doc_id, place, nth, false, json_extract(node, '$[' || nth || ']') FROM (SELECT doc_id, node, place, unnest(range(CAST(json_array_length(node) AS BIGINT))) AS nth FROM w WHERE json_type(node) = 'ARRAY')
  )
), l AS (
  SELECT doc_id, list_append(list_append(place, -1), nth) AS place, json_extract(node, '$[' || nth || ']') AS item FROM (SELECT doc_id, node, place, unnest(range(CAST(json_array_length(node) AS BIGINT))) AS nth FROM w WHERE listed)
), t AS (
  SELECT doc_id, place, CASE json_type(item) WHEN 'VARCHAR' THEN trim(json_extract_string(item, '$')) WHEN 'OBJECT' THEN trim(array_to_string(list_filter(list_transform(['title', 'name', 'url', 'externalURL', 'repo', 'path', 'id', 'label'], lambda k: json_extract_string(item, '$.' || k)), lambda x: x IS NOT NULL), ' | ')) END AS told FROM l
), f AS (
  SELECT doc_id, told, min(place) AS place FROM t WHERE told <> '' GROUP BY ALL
)
SELECT i.doc_id, coalesce(string_agg(told, '; ' ORDER BY place), '') AS sources FROM i LEFT JOIN f ON i.doc_id = f.doc_id GROUP BY i.doc_id
"""

#: Payloads with one or two description blocks: sound ones, unescaped quotes and backslashes, raw line ends outside a block, blocks
#: without ids, and texts that no block mends.
PAYLOADS = {
    "doc_id": "doc_id",
    "content": r"""concat('{"id": ', doc_id, CASE WHEN doc_id % 7 = 5 THEN ', ' ELSE '' END, ', "text": "', lang, ' [FIGURE_DESCRIPTIONS] ',
      CASE doc_id % 7 WHEN 0 THEN '- none here' WHEN 4 THEN concat('seen "STM32CubeX:d', doc_id % 60, '.pdf:p1:f1" so') ELSE concat('- R:d', doc_id % 60, '.pdf:p1:f1: bad "quote" ', chr(92), ' and ', chr(10), ' - R:d', (doc_id + 7) % 60, '.pdf:p1:f1 more') END,
      ' [/FIGURE_DESCRIPTIONS] then', CASE doc_id % 7 WHEN 2 THEN concat(' [FIGURE_DESCRIPTIONS]-R:d', doc_id % 30, '.pdf:p1:f1:"[/FIGURE_DESCRIPTIONS]') WHEN 3 THEN chr(10) WHEN 6 THEN ' "loose"' ELSE '' END, '"}')""",
}
#: Descriptions of half the figures from the benchmark's texts, with quotes, backslashes and line ends of their own.
DESCRIPTIONS = {
    "figure_id": "concat(CASE WHEN item_id % 3 = 0 THEN 'STM32CubeX' ELSE 'R' END, ':d', item_id, '.pdf:p1:f1')",
    "description": "concat(' \"', replace(coalesce(text, ''), ' ', CASE WHEN item_id % 4 = 0 THEN chr(10) WHEN item_id % 4 = 1 THEN chr(9) ELSE ' ' END), chr(92), chr(1), '\" ')",
}


def payload_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = payload_repair.repaired(made(spark, sf_dir, "documents", PAYLOADS), made(spark, sf_dir, "benchmark", DESCRIPTIONS), "doc_id")
    told = F.when(F.col("status") != "failed", F.get_json_object("content", "$.text"))
    return out.select("doc_id", "status", F.md5(F.when(F.col("status") != "relaxed", F.col("content"))).alias("content"), F.md5(told).alias("told"))


PAYLOAD_REPAIRS = rf"""
WITH i AS ({made_sql("documents", PAYLOADS)}), d AS ({made_sql("benchmark", DESCRIPTIONS)}),
e AS (SELECT figure_id, regexp_replace(replace(replace(replace(replace(replace(regexp_replace(max(description), '^\s+|\s+$', '', 'g'), chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't'), '[\x00-\x1f]', '', 'g') AS told FROM d GROUP BY 1),
b AS (SELECT doc_id, unnest(regexp_extract_all(content, '(?s)\[FIGURE_DESCRIPTIONS\].*?\[/FIGURE_DESCRIPTIONS\]')) AS block, unnest(range(len(regexp_extract_all(content, '(?s)\[FIGURE_DESCRIPTIONS\].*?\[/FIGURE_DESCRIPTIONS\]')))) AS nth FROM i WHERE NOT json_valid(content)),
g AS (SELECT *, CASE WHEN len(s) > 0 THEN s ELSE regexp_extract_all(block, '(STM32Cube\w+:[^:]+\.pdf:p\d+:f\d+)', 1) END AS ids FROM (SELECT *, regexp_extract_all(block, '-\s*([^\s:]+:[^\s:]+\.pdf:p\d+:f\d+):?\s*', 1) AS s FROM b)),
l AS (SELECT doc_id, nth, string_agg('- ' || id || ': ' || CASE WHEN coalesce(told, '') = '' THEN 'No description available.' ELSE told END, ' ' ORDER BY place) AS lines FROM (SELECT doc_id, nth, unnest(ids) AS id, unnest(range(len(ids))) AS place FROM g) LEFT JOIN e ON id = figure_id GROUP BY doc_id, nth),
n AS (SELECT g.doc_id, list(CASE WHEN lines IS NULL THEN block ELSE '[FIGURE_DESCRIPTIONS] ' || lines || ' [/FIGURE_DESCRIPTIONS]' END ORDER BY g.nth) AS blocks FROM g LEFT JOIN l ON g.doc_id = l.doc_id AND g.nth = l.nth GROUP BY g.doc_id),
p AS (SELECT i.doc_id, content, CASE WHEN json_valid(content) THEN NULL ELSE array_to_string(flatten(list_transform(list_zip(string_split_regex(content, '(?s)\[FIGURE_DESCRIPTIONS\].*?\[/FIGURE_DESCRIPTIONS\]'), coalesce(blocks, [])), lambda x: [coalesce(x[1], ''), coalesce(x[2], '')])), '') END AS patched FROM i LEFT JOIN n ON i.doc_id = n.doc_id),
s AS (SELECT *, replace(coalesce(patched, content), chr(10), chr(92) || 'n') AS flat, CASE WHEN patched IS NULL THEN 'ok' WHEN json_valid(patched) THEN 'fixed' WHEN json_valid(replace(patched, chr(10), chr(92) || 'n')) THEN 'relaxed' ELSE 'failed' END AS status FROM p)
SELECT doc_id, status, CASE status WHEN 'fixed' THEN md5(patched) WHEN 'relaxed' THEN NULL ELSE md5(content) END AS content, CASE WHEN status <> 'failed' THEN md5(json_extract_string(CASE status WHEN 'relaxed' THEN flat WHEN 'ok' THEN content ELSE patched END, '$.text')) END AS told FROM s
"""

def array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as one JSON array for each source, and what the files hold when they are read again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    folder = f"{shared_folder(spark)}/arrays-{uuid.uuid4().hex}"
    committed.json_array_files(docs, folder, "source")
    back = committed.read_arrays(spark, folder, "doc_id bigint, source string, text string")
    return back.groupBy("file").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.sum(F.length(text_of("text"))).alias("chars"), F.md5(F.array_join(F.sort_array(F.collect_list(F.md5(text_of("text")))), "")).alias("texts"))


ARRAY_FILES = """
SELECT regexp_replace(source, '[^A-Za-z0-9.-]', '_', 'g') || '.json' AS file, count(*) AS docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars,
  md5(string_agg(md5(coalesce(text, '')), '' ORDER BY md5(coalesce(text, '')))) AS texts FROM documents WHERE source IS NOT NULL GROUP BY 1
"""

QUERIES = {"array_files": array_files, "nested_sources": nested_sources, "payload_repairs": payload_repairs}

ORACLE_SQL = {"array_files": ARRAY_FILES, "nested_sources": NESTED_SOURCES, "payload_repairs": PAYLOAD_REPAIRS}
