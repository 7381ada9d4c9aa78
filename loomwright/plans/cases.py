"""Queries that reach the branches of materials, requests, rescued cards and question types with the tables' own values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import text
from loomwright.operators import cards, diagnostic, issues, resolver, tagging
from loomwright.plans.support import DIAGNOSTIC, bar, listed, made, made_sql

#: Bills of materials of 0 to 39 components, without a component, without components, other JSON and plain text.
MATERIALS = {
    "doc_id": "doc_id",
    "content": """CASE doc_id % 6
      WHEN 0 THEN concat('{"metadata": {"component": {"name": "', coalesce(source, ''), '", "version": "', doc_id % 9, '.1", "type": "library"}}, "components": [', repeat(concat('{"name": "', coalesce(lang, ''), '", "version": "', doc_id % 3, '"}, '), CAST(doc_id % 40 AS INT)), '{"name": "last"}]}')
      WHEN 1 THEN concat('{"metadata": {"component": {"name": "n', doc_id, '"}}, "more": 1}') WHEN 2 THEN '{"components": []}'
      WHEN 3 THEN concat('{"metadata": {"tools": []}, "other": "', repeat('x', CAST(doc_id % 3000 AS INT)), '"}')
      WHEN 4 THEN concat('{"components": [', repeat('{"version": "2"}, ', 19), '{"name": "b', doc_id, '"}]}') ELSE concat('no json ', coalesce(text, '')) END""",
}


def bill_of_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, "documents", MATERIALS).select("doc_id", F.md5(text.json_metadata(F.col("content"))).alias("told"), F.length(text.json_metadata(F.col("content"))).alias("chars"))


BILL_OF_MATERIALS = f"""
WITH i AS ({made_sql("documents", MATERIALS)}), j AS (SELECT *, CASE WHEN json_valid(content) THEN content::JSON END AS v FROM i),
p AS (SELECT *, json_extract(v, '$.metadata.component') AS own, CASE WHEN json_exists(v, '$.components') THEN CAST(json_extract(v, '$.components') AS JSON[]) END AS parts FROM j),
t AS (SELECT doc_id, content, array_to_string(list_filter([
    CASE WHEN own IS NOT NULL THEN 'Name: ' || coalesce(json_extract_string(own, '$.name'), 'N/A') END, CASE WHEN own IS NOT NULL THEN 'Version: ' || coalesce(json_extract_string(own, '$.version'), 'N/A') END,
    CASE WHEN own IS NOT NULL THEN 'Type: ' || coalesce(json_extract_string(own, '$.type'), 'N/A') END, CASE WHEN parts IS NOT NULL THEN 'Dependencies count: ' || len(parts) END,
    nullif(array_to_string(list_transform(parts[1:20], lambda x: '  - ' || coalesce(json_extract_string(x, '$.name'), '') || ' ' || coalesce(json_extract_string(x, '$.version'), '')), chr(10)), ''),
    CASE WHEN len(parts) > 20 THEN '  ... and ' || (len(parts) - 20) || ' more' END], lambda x: x IS NOT NULL), chr(10)) AS told FROM p),
o AS (SELECT doc_id, CASE WHEN told = '' THEN substr(content, 1, 2000) ELSE told END AS told FROM t)
SELECT doc_id, md5(told) AS told, CAST(length(told) AS INTEGER) AS chars FROM o
"""


#: Documents as clean files: paths with signs that an address encodes, with other slashes, without a path or repository; images with and without a count.
RECORDS = {
    "doc_id": "doc_id", "repo": "CASE doc_id % 5 WHEN 0 THEN 'CubeH7' WHEN 1 THEN 'cube_f4' WHEN 2 THEN source WHEN 3 THEN '' END",
    "path": """CASE doc_id % 7 WHEN 0 THEN concat('/Projects/Examples/ADC ', doc_id, '/main.c') WHEN 1 THEN concat('docs', chr(92), 'a+b*c~', doc_id, '.md') WHEN 2 THEN 'Src/größe #1 & 50%.c' WHEN 3 THEN '' WHEN 4 THEN 'x/Examples'
      WHEN 5 THEN concat('//Examples/(', coalesce(lang, ''), ')/[', doc_id, ']=@:!.h') END""",
    "clean_text": "text", "file_type": "CASE doc_id % 3 WHEN 0 THEN 'driver_source' WHEN 1 THEN '' END", "github_url": "CASE doc_id % 11 WHEN 0 THEN concat('https://x/', doc_id) WHEN 1 THEN '' END",
    "images": "CASE doc_id % 4 WHEN 0 THEN 'u1,u2,u3' WHEN 1 THEN '' WHEN 2 THEN 'u4' END", "images_count": "CASE doc_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 9 END", "content_extractor": "CASE doc_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN '' END",
}


def file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "documents", RECORDS).withColumn("media_urls", F.when(F.col("images").isNotNull(), listed("images")))
    rows = rows.withColumn("image_records", F.transform("media_urls", lambda u: F.struct(u.alias("image_url")))).drop("images")
    return issues.file_records(rows, "owner").select(
        "doc_id", "id", "type", "source_kind", "mcu_package", "mcu_series", "file_type", "path", "github_url", "example_name", "ingest_version", bar("image_urls").alias("images"), "images_count", "content_extractor", "is_valid",
        F.md5("clean_text").alias("text_md5"),
    )


FILE_RECORDS = f"""
WITH i AS ({made_sql("documents", RECORDS)}),
n AS (SELECT *, coalesce(path, '') AS p, replace(coalesce(path, ''), chr(92), '/') AS q, list_filter(string_split(images, ','), lambda x: x <> '') AS u FROM i),
s AS (SELECT *, regexp_replace(q, '^/+', '') AS bare, string_split(q, '/') AS steps FROM n)
SELECT doc_id, lower(coalesce(repo, '')) || '-file-' || sha1(lower(coalesce(repo, '')) || ':' || bare)[1:16] AS id, 'file' AS type, 'file' AS source_kind, repo AS mcu_package,
  CASE WHEN contains(upper(repo), 'H7') THEN 'H7' WHEN contains(upper(repo), 'F4') THEN 'F4' WHEN contains(upper(repo), 'H5') THEN 'H5' END AS mcu_series, coalesce(nullif(file_type, ''), 'other') AS file_type, p AS path,
  coalesce(nullif(github_url, ''), CASE WHEN repo <> '' AND p <> '' THEN 'https://github.com/owner/' || repo || '/blob/master/' || replace(url_encode(bare), '%2F', '/') END) AS github_url,
  CASE WHEN list_position(steps, 'Examples') > 0 THEN steps[list_position(steps, 'Examples') + 1] END AS example_name, 'v2.0' AS ingest_version, coalesce(array_to_string(u, '|'), '') AS images,
  coalesce(nullif(CAST(images_count AS BIGINT), 0), len(u), 0) AS images_count, coalesce(nullif(content_extractor, ''), 'text') AS content_extractor, length(coalesce(text, '')) >= 100 AS is_valid, md5(coalesce(text, '')) AS text_md5
FROM (SELECT s.*, clean_text AS text FROM s)
"""


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's suppliers as its requests, of which every third is not known: bodies of the first two numbers, where they are."""
    refs = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias("numbers"))
    known = spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("pr_number"), F.col("s_name").alias("body"))
    named = refs.select(F.col("l_orderkey").alias("issue_number"), F.posexplode("numbers").alias("pos", "pr_number")).join(known, "pr_number")
    return resolver.request_bodies(named).select("issue_number", "pos", "pr_number", "body")


REQUEST_BODIES = """
WITH n AS (SELECT l_orderkey AS issue_number, list_sort(list(DISTINCT l_suppkey))[1:2] AS numbers FROM lineitem GROUP BY 1),
p AS (SELECT issue_number, unnest(numbers) AS pr_number, unnest(range(len(numbers))) AS pos FROM n)
SELECT issue_number, CAST(pos AS INTEGER) AS pos, pr_number, s_name AS body FROM p JOIN supplier ON s_suppkey = pr_number WHERE s_suppkey % 3 <> 0
"""


def rescued_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnostic cards as they are made by default: of rescued issues and of all resolver cases."""
    rows = made(spark, sf_dir, "orders", DIAGNOSTIC)
    issues = cards.card_issues(rows.where("has_issue").withColumn("issue_number", F.expr("CASE WHEN k % 13 = 0 THEN null ELSE k END")))
    nothing = F.lit(None).cast("string")
    issue = F.struct(F.lit("RepoF4").alias("repo"), "issue_number", F.col("title").alias("issue_title"), "github_url", F.col("card").alias("st_ready_text"), "component", "board", "layer", "issue_kind", "severity", "mcu_series", "evidence_strength", "rescue_applied", F.array("labels").alias("labels"))
    none = F.array().cast("array<string>")
    solved = F.struct(
        F.col("k").alias("issue_number"), F.concat(F.lit("Case "), F.col("k")).alias("issue_title"), nothing.alias("issue_url"), F.col("solved").alias("resolver_card_text"), F.col("status").alias("resolution_status"), F.col("confidence").alias("link_confidence"), none.alias("linked_commit_shas"),
        none.alias("linked_pr_urls"), none.alias("linked_commit_urls"), none.alias("linked_file_paths"), none.alias("impacted_modules"), none.alias("impacted_components"), F.col("merged_files").alias("merged_pr_with_file_evidence"),
    )
    both = cards.merged(issues.select("issue_number", issue.alias("issue")), rows.where("has_case").select(F.col("k").alias("issue_number"), solved.alias("case")), "issue_number")
    out = diagnostic.cards(both.select(F.lit("RepoF4").alias("repo"), "issue", "case"))
    return out.select(F.col("issue_number").alias("k"), "id", "title", "rescue_applied", F.array_join("source_types", ",").alias("source_types"), "resolution_status")


RESCUED_CARDS = f"""
WITH i AS (SELECT *, has_issue AND rescue_applied AND k % 13 <> 0 AS issue FROM ({made_sql("orders", DIAGNOSTIC)}))
SELECT k, 'diag::RepoF4::issue::' || k AS id, CASE WHEN issue AND title <> '' THEN title WHEN has_case THEN 'Case ' || k ELSE trim(regexp_extract(card, 'Problem: *([^' || chr(10) || ']*)', 1)) END AS title,
  issue AS rescue_applied, CASE WHEN issue AND has_case THEN 'rescued_issue,resolver_case' WHEN issue THEN 'rescued_issue' ELSE 'resolver_case' END AS source_types, CASE WHEN has_case THEN status END AS resolution_status
FROM i WHERE issue OR has_case
"""

#: Questions that ask for an error, a symbol or a way, by their own words or by their tags alone.
QUESTIONS = {
    "doc_id": "doc_id",
    "question": """concat(CASE doc_id % 7 WHEN 0 THEN 'Which HAL_' WHEN 1 THEN 'A CRASH after ' WHEN 2 THEN 'The register of ' WHEN 3 THEN 'Device is stuck in a callback ' WHEN 4 THEN 'unknown  device ' ELSE '' END, substr(coalesce(text, ''), 1, 60))""",
    "tags": "CASE doc_id % 5 WHEN 0 THEN 'api,Debugging' WHEN 1 THEN null WHEN 2 THEN 'bug' ELSE lang END",
}


def question_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, "documents", QUESTIONS).select("doc_id", tagging.query_type(F.col("question")).alias("by_words"), tagging.query_type(F.col("question"), F.col("tags")).alias("by_tags"))


_ERROR = "regexp_matches(lower(question), 'error|fault|crash|stuck|nack|unknown device')"
_SYMBOL = "regexp_matches(lower(question), 'hal_|api|function|register|callback')"
QUESTION_TYPES = f"""
WITH i AS ({made_sql("documents", QUESTIONS)})
SELECT doc_id, CASE WHEN {_ERROR} THEN 'error_message' WHEN {_SYMBOL} THEN 'api_symbol' ELSE 'how_to' END AS by_words,
  CASE WHEN {_ERROR} OR contains(lower(coalesce(tags, '')), 'debug') THEN 'error_message' WHEN {_SYMBOL} THEN 'api_symbol' ELSE 'how_to' END AS by_tags FROM i
"""

QUERIES = {"file_records": file_records, "bill_of_materials": bill_of_materials, "request_bodies": request_bodies, "rescued_cards": rescued_cards, "question_types": question_types}

ORACLE_SQL = {"file_records": FILE_RECORDS, "bill_of_materials": BILL_OF_MATERIALS, "request_bodies": REQUEST_BODIES, "rescued_cards": RESCUED_CARDS, "question_types": QUESTION_TYPES}
