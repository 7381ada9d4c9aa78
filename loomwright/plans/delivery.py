"""Resolver cases, audits, images, answers, cleaning, splits and similarity on cases made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import images, rules, text
from loomwright.functions.rules import score_band
from loomwright.operators import answers, audits, issues, quality, resolver, similarity, windows
from loomwright.plans.support import K, bar, case, listed, made, made_sql
from loomwright.session import table

# ---- resolver cases

CASES = {
    "issue_number": K, "repo": "'RepoA'", "issue_title": case(K, f"'Case  ' || {K}", "'A title. More'"), "labels": case(K, "'bug,spi'", "''"), "issue_state": case(K, "'open'", "null", "'closed'"), "issue_url": f"'https://x/i/' || {K}",
    "resolution_status": case(K, "'merged_fix'", "'candidate_fix'", "'commit_only_candidate'", "'reference_only'", "'unlinked'", "null"), "link_confidence": case(K, "'high'", "'medium'", "null"), "link_score": case(K, "1.0e0", "0.35e0", "0.0e0", "null"),
    "merged_pr_with_file_evidence": f"{K} % 3 = 0",
}
COMMITS = {
    "issue_number": "l_orderkey", "pr_number": "l_suppkey", "sha": "'C' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey", "message": case("l_linenumber", "'Fix the part ' || l_partkey || '. It was broken'", "'Merge branch x'", "''"), "github_url": case("l_linenumber", "'https://x/c/' || l_partkey", "null"),
    "file_a": "'Drivers/HAL_Driver/P' || l_partkey % 50 || '.c'", "file_b": case("l_suppkey", "'Middlewares' || chr(92) || 'q' || l_suppkey % 7 || '.c'", "'/Projects/r.c'", "''", "'top.md'"), "status": case("l_partkey", "'modified'", "null", "''", "'added'"), "n": "l_partkey % 9",
}
REQUESTS = {"pr_number": "s_suppkey", "title": case("s_suppkey", "s_name || '  x'", "''", "null"), "body": case("s_suppkey", "'See ![i](http://h/i.png) and <img src=a> ' || s_suppkey", "''", "repeat('long text ', 200)", "null"), "github_url": case("s_suppkey", "'https://x/p/' || s_suppkey", "null")}
FILE_DOCS = {"id": "p_partkey", "path": "'/drivers/hal_driver/p' || p_partkey % 60 || '.C'", "file_type": case("p_partkey", "'driver_source'", "'other'"), "component": case("p_partkey", "'SPI'", "null", "'ADC'"), "board": case("p_partkey", "null", "'B1'"), "example_name": "null", "github_url": case("p_partkey", "'https://x/f/' || p_partkey", "null"),
             "is_valid": "p_partkey % 4 <> 0"}
_LINKED = "l_tax >= 0.03"


def _cases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    lines = made(spark, sf_dir, "lineitem", COMMITS)
    refs = made(spark, sf_dir, "lineitem", COMMITS, _LINKED).groupBy("issue_number").agg(F.sort_array(F.collect_set(F.upper("sha"))).alias("linked_commit_shas"), F.sort_array(F.collect_set(F.col("pr_number").cast("long"))).alias("linked_pr_numbers"))
    none = F.array().cast
    cases = made(spark, sf_dir, "orders", CASES).withColumn("issue_labels", listed("labels")).join(refs, "issue_number", "left")
    cases = cases.withColumns({"linked_commit_shas": F.coalesce("linked_commit_shas", none("array<string>")), "linked_pr_numbers": F.coalesce("linked_pr_numbers", none("array<bigint>"))})
    change = lambda name, extra: F.struct(F.col(name).alias("filename"), "status", (F.col("n") + extra).cast("int").alias("additions"), F.col("n").cast("int").alias("deletions"), (F.col("n") * 2 + extra).cast("int").alias("changes"))
    commits = lines.select("sha", "message", "github_url", F.array(change("file_a", 0), change("file_b", 1)).alias("files_changed"))
    prs = made(spark, sf_dir, "supplier", REQUESTS).withColumn("pr_number", F.col("pr_number").cast("long"))
    return cases, commits, prs, made(spark, sf_dir, "part", FILE_DOCS)


def resolver_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases, commits, prs, docs = _cases(spark, sf_dir)
    out = resolver.resolver_cases(cases, commits, prs, docs, "https://host/owner/")
    first = F.col("primary_changed_file")
    return out.select(
        "id", F.col("resolver_card_text").alias("text"), F.col("changed_files_total").cast("long").alias("files"), F.col("matched_docs_files_count").cast("long").alias("matched"), "match_rate", F.col("unmatched_files_count").cast("long").alias("unmatched"), bar("linked_file_paths").alias("paths"),
        bar("impacted_modules").alias("modules"), bar("impacted_components").alias("components"), bar("impacted_boards").alias("boards"), bar("impacted_file_types").alias("types"), first["path"].alias("first_path"), first["status"].alias("first_status"), first["changes"].alias("first_changes"), first["score"].alias("first_score"),
        first["github_url"].alias("first_url"), F.array_join(first["commit_shas"], "|").alias("first_shas"), F.size("linked_pr_urls").alias("pr_urls"), F.size("linked_commit_urls").alias("commit_urls"), "primary_pr_number", "primary_commit_sha",
    )


def resolver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = _cases(spark, sf_dir)[0]
    return resolver.summary(cases, resolver.wanted(cases, True))


_KEPT = "resolution_status IN ('merged_fix', 'candidate_fix', 'commit_only_candidate')"
RESOLVER_CARDS = f"""
WITH c AS (SELECT * FROM ({made_sql("orders", CASES)}) WHERE {_KEPT}), l AS ({made_sql("lineitem", COMMITS)}), w AS ({made_sql("lineitem", COMMITS, _LINKED)}), p AS ({made_sql("supplier", REQUESTS)}), d AS ({made_sql("part", FILE_DOCS)}),
r AS (SELECT DISTINCT issue_number, lower(sha) AS sha, upper(sha) AS up FROM w WHERE issue_number IN (SELECT issue_number FROM c)), ro AS (SELECT *, row_number() OVER (PARTITION BY issue_number ORDER BY up) AS pos FROM r),
k AS (SELECT ro.issue_number, pos, ro.sha, message, l.github_url AS url, file_a, file_b, status, n FROM ro JOIN l ON lower(l.sha) = ro.sha),
f AS (SELECT issue_number, sha, pos * 10 AS seen, file_a AS name, status, n AS adds, n AS dels, n * 2 AS chg FROM k UNION ALL SELECT issue_number, sha, pos * 10 + 1, file_b, status, n + 1, n, n * 2 + 1 FROM k),
g AS (SELECT issue_number, lower(regexp_replace(replace(name, chr(92), '/'), '^/+', '')) AS key, arg_min(name, seen) AS name, arg_max(status, seen) FILTER (status IS NOT NULL AND status <> '') AS status, CAST(sum(chg) AS BIGINT) AS chg, count(*) AS touched,
  array_to_string(list_sort(list_distinct(list(sha))), '|') AS shas, min(seen) AS seen FROM f WHERE name <> '' GROUP BY 1, 2),
dd AS (SELECT lower(regexp_replace(path, '^/+', '')) AS key, arg_min(d, (CASE WHEN is_valid THEN 0 ELSE 1 END, id)) AS doc FROM d GROUP BY 1),
h AS (SELECT g.*, doc, regexp_replace(replace(name, chr(92), '/'), '^/+', '') AS path, coalesce(doc.github_url, 'https://host/owner/RepoA/blob/master/' || regexp_replace(replace(name, chr(92), '/'), '^/+', '')) AS furl, chg + CASE WHEN doc IS NULL THEN 0 ELSE 20 END AS score,
  CASE WHEN starts_with(g.key, 'drivers/') AND contains(g.key, 'hal_driver') THEN 'HAL_Driver' WHEN starts_with(g.key, 'middlewares/') THEN 'Middlewares' WHEN starts_with(g.key, 'projects/') THEN 'Projects' ELSE string_split(g.key, '/')[1] END AS module FROM g LEFT JOIN dd ON dd.key = g.key),
e AS (SELECT issue_number, count(*) AS files, count(doc) AS matched, round_even(count(doc) / count(*), 4) AS match_rate, array_to_string(list_sort(list_distinct(list(doc.path) FILTER (doc IS NOT NULL))), '|') AS paths, array_to_string(list_sort(list_distinct(list(module))), '|') AS modules,
  coalesce(array_to_string(list_sort(list_distinct(list(doc.component) FILTER (doc.component IS NOT NULL))), '|'), '') AS components, coalesce(array_to_string(list_sort(list_distinct(list(doc.board) FILTER (doc.board IS NOT NULL))), '|'), '') AS boards,
  coalesce(array_to_string(list_sort(list_distinct(list(doc.file_type) FILTER (doc IS NOT NULL))), '|'), '') AS types, arg_min(h, (-chg, -touched, seen)) AS first FROM h GROUP BY 1),
q AS (SELECT DISTINCT issue_number, pr_number FROM w), qo AS (SELECT *, row_number() OVER (PARTITION BY issue_number ORDER BY pr_number) AS pos FROM q), qp AS (SELECT qo.*, title, body, github_url FROM qo JOIN p USING (pr_number)),
qr AS (SELECT *, row_number() OVER (PARTITION BY issue_number ORDER BY pos) AS nth, regexp_replace(regexp_replace(trim(coalesce(body, '')), '!\\[[^\\]]*\\]\\([^)]+\\)', '[IMAGE ATTACHED]', 'g'), '<img\\b[^>]*>', '[IMAGE ATTACHED]', 'gi') AS b0 FROM qp),
qs AS (SELECT *, CASE WHEN length(b0) <= 1500 THEN b0 ELSE regexp_replace(b0[:1500], ' [^ ]*$', '') || ' [truncated]' END AS b FROM qr),
qa AS (SELECT issue_number, list(trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g')) ORDER BY pos) AS titles, count(github_url) AS pr_urls, string_agg('PR #' || pr_number || ' description: ' || b, chr(10) ORDER BY pos) FILTER (nth <= 2 AND b <> '') AS bodies, min(pr_number) AS primary_pr FROM qs GROUP BY 1),
ka AS (SELECT issue_number, list(CASE WHEN contains(message, '.') THEN string_split(message, '.')[1] || '.' ELSE message END ORDER BY pos) AS msgs, count(url) AS commit_urls FROM k GROUP BY 1), m AS (SELECT issue_number, min(up) AS primary_sha FROM r GROUP BY 1),
a AS (SELECT c.*, list_filter(coalesce(titles, []), lambda x: x <> '')[:3] AS t3, list_filter(coalesce(msgs, []), lambda x: x <> '')[:4] AS m4, bodies, coalesce(pr_urls, 0) AS pr_urls, coalesce(commit_urls, 0) AS commit_urls, primary_pr, primary_sha FROM c LEFT JOIN qa USING (issue_number) LEFT JOIN ka USING (issue_number) LEFT JOIN m USING (issue_number))
SELECT 'resolver::RepoA::issue::' || a.issue_number AS id, 'Problem: Issue #' || a.issue_number || ' - ' || trim(regexp_replace(issue_title, '\\s+', ' ', 'g')) || chr(10) || 'Context: repo=RepoA, labels=' || CASE WHEN labels = '' THEN 'none' ELSE replace(labels, ',', ', ') END || ', issue_state=' || coalesce(issue_state, 'None')
  || chr(10) || 'Resolver signal: resolution_status=' || resolution_status || ', confidence=' || coalesce(link_confidence, 'none') || ', score=' || CASE WHEN coalesce(link_score, 0) = 0 THEN '0' ELSE CAST(link_score AS VARCHAR) END || chr(10) || 'Assessment: '
  || CASE resolution_status WHEN 'merged_fix' THEN 'Fix likely integrated in mainline; prefer this as primary recommendation.' WHEN 'candidate_fix' THEN 'Potential fix identified, but integration status is uncertain.' ELSE 'Commit-level evidence exists, but PR linkage is incomplete.' END
  || CASE WHEN len(t3) > 0 THEN chr(10) || 'Candidate PRs: ' || array_to_string(t3, ' | ') ELSE '' END || CASE WHEN len(m4) > 0 THEN chr(10) || 'Commit evidence: ' || array_to_string(m4, ' | ') ELSE '' END
  || CASE WHEN merged_pr_with_file_evidence THEN chr(10) || 'File evidence: merged PR modifies files even when commit log is merge-heavy' ELSE '' END || coalesce(chr(10) || bodies, '')
  || chr(10) || 'Constraints: Validate against exact MCU series, board, firmware package version, and local project config before applying.' AS text,
  coalesce(files, 0) AS files, coalesce(matched, 0) AS matched, coalesce(match_rate, 0) AS match_rate, coalesce(files - matched, 0) AS unmatched, coalesce(paths, '') AS paths, coalesce(modules, '') AS modules, coalesce(components, '') AS components, coalesce(boards, '') AS boards, coalesce(types, '') AS types,
  first.path AS first_path, first.status AS first_status, first.chg AS first_changes, CAST(first.score AS DOUBLE) AS first_score, first.furl AS first_url, first.shas AS first_shas, CAST(pr_urls AS INT) AS pr_urls, CAST(commit_urls AS INT) AS commit_urls, primary_pr AS primary_pr_number, primary_sha AS primary_commit_sha
FROM a LEFT JOIN e USING (issue_number)
"""
RESOLVER_SUMMARY = f"""WITH c AS ({made_sql("orders", CASES)}) SELECT count(*) FILTER (coalesce(resolution_status, 'unlinked') <> 'unlinked') AS exported_cases, count(*) FILTER (resolution_status = 'merged_fix') AS merged_fix, count(*) FILTER (resolution_status = 'candidate_fix') AS candidate_fix,
  count(*) FILTER (resolution_status = 'commit_only_candidate') AS commit_only_candidate, count(*) FILTER (resolution_status = 'reference_only') AS reference_only, count(*) FILTER (merged_pr_with_file_evidence AND coalesce(resolution_status, 'unlinked') <> 'unlinked') AS merged_pr_with_file_evidence_cases,
  count(*) AS total_cases_in_input FROM c"""

# ---- audits

EVIDENCE = ("explicit_pr_numbers", "explicit_commit_shas", "message_inferred_commit_shas", "commits_via_linked_prs", "merge_like_commit_shas")
LINKS = {"issue_number": K, "resolution_status": case(K, "'unlinked'", "'unlinked'", "'merged_fix'"), "labels": case(K, "'bug, spi'", "''", "'question'", "'bug'"), "bits": f"{K} * 7 % 32"}


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "orders", LINKS).withColumn("issue_labels", F.split("labels", ","))
    return rows.withColumns({c: F.when(F.col("bits").bitwiseAND(1 << i) > 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")) for i, c in enumerate(EVIDENCE)})


def unlinked_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = _links(spark, sf_dir)
    rate = audits.unlinked_rate(links).select("unlinked_rate")  # one row
    return audits.unlinked_audit(links).select("reason", "issues", F.array_join(F.col("samples").cast("array<string>"), ",").alias("samples")).crossJoin(rate)


def unlinked_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.unlinked_labels(_links(spark, sf_dir))


_REASON = """CASE WHEN bits & 15 = 0 THEN 'no_pr_no_commit_signal' WHEN bits & 1 = 1 AND bits & 14 = 0 THEN 'pr_reference_without_commit_trace' WHEN bits & 15 = 4 THEN 'message_inferred_only_but_unconfirmed' WHEN bits & 16 = 16 AND bits & 6 = 0 THEN 'merge_only_history' ELSE 'other_mixed_gap' END"""
UNLINKED_AUDIT = f"""WITH i AS ({made_sql("orders", LINKS)}), u AS (SELECT *, {_REASON} AS reason FROM i WHERE resolution_status = 'unlinked')
SELECT reason, count(*) AS issues, array_to_string(list_sort(list(issue_number))[:25], ',') AS samples, (SELECT round_even(count(*) FILTER (resolution_status = 'unlinked') / count(*), 4) FROM i) AS unlinked_rate FROM u GROUP BY 1"""
UNLINKED_LABELS = f"""WITH i AS ({made_sql("orders", LINKS)}), l AS (SELECT trim(unnest(string_split(labels, ','))) AS label FROM i WHERE resolution_status = 'unlinked') SELECT label, count(*) AS n FROM l WHERE label <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""


def summary_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of orders by status that a summary states (wrongly for P) against numbers counted again."""
    counted = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    stored = counted.where("name <> 'O'").withColumn("n", F.when(F.col("name") == "P", F.col("n") + 1).otherwise(F.col("n")))
    return audits.summary_problems(stored, counted)


def artifact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.delivery_counts({n: table(spark, sf_dir, t) for n, t in (("issues_json", "orders"), ("files_json", "part"), ("resolver_cases_json", "customer"), ("diagnostic_cards_json", "supplier"))})


IMAGES = {"k": K, "source": case(K, "'issue_image'", "'pdf_figure'"), "alfred_description": case(K, "null", f"'A block diagram of part ' || {K}", "'  '", "''"), "description": case(K, "'Image.'", "null", f"'The text ' || {K} || ' that is read'", "''")}


def image_description_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.image_stats(made(spark, sf_dir, "orders", IMAGES), "source")


IMAGE_STATS = f"""WITH i AS ({made_sql("orders", IMAGES)}), d AS (SELECT source, coalesce(nullif(alfred_description, ''), description) AS t FROM i), n AS (SELECT *, length(trim(coalesce(t, ''))) AS n FROM d)
SELECT source, count(*) AS total_images, count(*) FILTER (n > 0) AS with_description, count(*) FILTER (n = 0) AS without_description, count(*) FILTER (t = '') AS empty_description, count(*) FILTER (n BETWEEN 1 AND 19) AS short_descriptions, coalesce(round_even(avg(n) FILTER (n > 0), 1), 0) AS avg_description_length FROM n GROUP BY 1"""

# ---- images in texts

PICTURES = {
    "k": K, "text": case(K, f"'See ![a](https://x/' || {K} || '.png \"t\") and <IMG src=''https://y/user-attachments/assets/1''> at https://z/p.jpg'", "'One [IMAGE ATTACHED] two [image attached] three'", "'https://github.com/a/assets/b) and ![b](<https://q/w.svg>) no.html https://x/no.html'", "null", "'plain'"),
    "answer": case(K, f"'DESCRIPTION: A ' || {K} || chr(10) || ' OCR_TEXT: NONE'", "'DESCRIPTION: board' || chr(10) || 'OCR_TEXT: VDD' || chr(10) || 'GND'", "'just words'", "''"), "status": case(K, "'ok'", "'ok'", "'error'"), "caption": case(K, "'Fig. 3 shows'", "'Block Diagram'", "'table 2'"),
}


def image_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, parts = F.col("text"), F.col("parts")
    rows = made(spark, sf_dir, "orders", PICTURES).withColumn("parts", images.description_parts(F.col("answer")))
    analysis = F.struct(F.lit("https://x/1.png").alias("image_url"), "status", parts["description"].alias("description"), parts["ocr_text"].alias("ocr_text"), F.lit("late").alias("error"))
    described = F.create_map(F.lit("https://q/w.svg"), F.lit("W"), F.lit("https://y/user-attachments/assets/1"), F.lit("Y"))
    return rows.select(
        "k", F.array_join(images.image_urls(t), " ").alias("urls"), parts["description"].alias("told"), parts["ocr_text"].alias("read"), images.is_caption(F.col("caption")).alias("caption"), images.inline_text(analysis).alias("inline"),
        images.replace_attached(t, F.array(analysis)).alias("filled"), images.replace_linked(t, described).alias("linked"), images.context_block(t, F.array(analysis)).alias("block"), text.json_escaped(F.col("answer")).alias("escaped"),
    )


_IMG = r"list_filter(list_transform({}, lambda x: trim(x, '<> ')), lambda x: regexp_matches(lower(x), '^https?://') AND (regexp_matches(lower(x), '\.(png|jpg|jpeg|gif|webp|bmp|svg)$') OR (contains(lower(x), '/assets/') AND (contains(lower(x), 'user-attachments') OR contains(lower(x), 'github.com')))))"
_FOUND = _IMG.format(
    r"""list_concat(list_transform(regexp_extract_all(t, '!\[[^\]]*\]\(([^)]+)\)', 1), lambda g: string_split(trim(g), ' ')[1]), regexp_extract_all(t, '(?i)<img\b[^>]*?\bsrc\s*=\s*[''"]([^''"]+)[''"][^>]*>', 1), regexp_extract_all(t, '(?i)https?://[^\s\]>''")]+'))"""
)
IMAGE_TEXTS = f"""WITH i AS (SELECT *, coalesce(text, '') AS t FROM ({made_sql("orders", PICTURES)})), u AS (SELECT *, {_FOUND} AS us,
  CASE WHEN starts_with(answer, 'DESCRIPTION:') THEN trim(regexp_extract(answer, '^DESCRIPTION:([^' || chr(10) || ']*)', 1)) ELSE answer END AS told, CASE WHEN contains(answer, 'OCR_TEXT:') THEN replace(trim(string_split(answer, 'OCR_TEXT:')[2]), 'NONE', '') ELSE '' END AS read FROM i),
v AS (SELECT *, CASE WHEN status <> 'ok' OR told || read = '' THEN '[IMAGE DESCRIPTION UNAVAILABLE]' ELSE concat_ws(' ', CASE WHEN told <> '' THEN '[IMAGE DESCRIPTION] ' || told END, CASE WHEN read <> '' THEN '[IMAGE TEXT] ' || read END) END AS inline FROM u)
SELECT k, array_to_string(list_filter(us, lambda x, j: list_position(us, x) = j), ' ') AS urls, told, read, regexp_matches(lower(caption), 'figure|fig\\.|diagram|overview|architecture|workflow|illustration') AS caption, inline,
  CASE WHEN contains(t, 'ATTACHED') THEN 'One ' || inline || ' two [IMAGE DESCRIPTION UNAVAILABLE] three' ELSE t END AS filled, replace(replace(t, '![b](<https://q/w.svg>)', 'W'), '<IMG src=''https://y/user-attachments/assets/1''>', 'Y') AS linked,
  t || chr(10) || chr(10) || 'Image-derived context:' || chr(10) || '1. URL: https://x/1.png' || chr(10) || CASE WHEN status <> 'ok' THEN '   Description: [ERROR] late' ELSE '   Description: ' || CASE WHEN told = '' THEN '[none]' ELSE told END || CASE WHEN read <> '' THEN chr(10) || '   OCR Text: ' || read ELSE '' END END AS block,
  replace(answer, chr(10), chr(92) || 'n') AS escaped FROM v"""

# ---- answers

ANSWERS = {
    "k": K, "raw": case(K, f"'{{\"completion\": \" done ' || {K} || ' \"}}'", "'{\"text\": \"\", \"content\": \"c\"}'", "'{\"choices\": [{\"message\": {\"content\": \"m\"}}]}'", "'{\"choices\": [{\"text\": \"t\"}]}'", "'{\"completion\": 5, \"answer\": \"a HAL_X\"}'", "'not json'",
                        "'{\"sources\": [{\"title\": \"T\", \"url\": \"u\"}, \"plain\", \"plain\"], \"final\": \"f\"}'", "'{\"data\": {\"documents\": [{\"id\": 3, \"label\": \"L\"}]}}'", "'[]'"),
    "qid": f"'Q' || {K} % 3", "entry": case(K, "'{\"deleted\": true}'", "'{\"isDeleted\": 0, \"status\": \"Archived\"}'", "'{\"active\": false}'", "'{\"deleted_at\": \"2020\"}'", "'{\"active\": true, \"is_deleted\": \"no\"}'", "'{\"deleted\": false, \"status\": \"removed\"}'", "'{\"is_deleted\": \"yes\"}'", "'{}'"),
}


def answer_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "orders", ANSWERS).withColumn("answer", answers.answer_text(F.col("raw")))
    asked = spark.createDataFrame([("Q0", "hal_[a-z]+|^m$"), ("Q1", ""), ("Q2", "([broken")], "qid string, forbidden string")
    checked = answers.forbidden_by_question(rows, asked, "qid", "answer", "forbidden")
    return checked.select("k", "answer", F.array_join(answers.answer_sources(F.col("raw")), "; ").alias("sources"), "hallucination", answers.is_gone(F.col("entry")).alias("gone"))


ANSWER_EXTRACTION = f"""WITH i AS ({made_sql("orders", ANSWERS)}), v AS (SELECT *, CASE WHEN json_valid(raw) THEN raw::JSON END AS j, entry::JSON AS e FROM i),
a AS (SELECT *, coalesce({", ".join(f"CASE WHEN json_type(j, '$.{p}') = 'VARCHAR' THEN nullif(trim(json_extract_string(j, '$.{p}')), '') END" for p in ("completion", "text", "content", "message", "answer", "final", "choices[0].message.content", "choices[0].text", "choices[0].content"))}, '') AS answer FROM v)
SELECT k, answer, CASE WHEN json_exists(j, '$.sources') THEN json_extract_string(j, '$.sources[0].title') || ' | ' || json_extract_string(j, '$.sources[0].url') || '; ' || json_extract_string(j, '$.sources[1]')
    WHEN json_exists(j, '$.data.documents') THEN json_extract_string(j, '$.data.documents[0].id') || ' | ' || json_extract_string(j, '$.data.documents[0].label') ELSE '' END AS sources,
  CASE WHEN qid = 'Q0' THEN CASE WHEN regexp_matches(lower(answer), 'hal_[a-z]+|^m$') THEN '1' ELSE '0' END ELSE '' END AS hallucination,
  CASE WHEN json_type(e, '$.deleted') = 'BOOLEAN' THEN (e->>'deleted')::BOOLEAN WHEN lower(coalesce(e->>'is_deleted', '')) IN ('1', 'true', 'yes', 'y') THEN true WHEN coalesce(e->>'deleted_at', '') <> '' THEN true
    WHEN lower(coalesce(e->>'status', '')) IN ('deleted', 'inactive', 'archived', 'removed') THEN true WHEN json_type(e, '$.active') = 'BOOLEAN' THEN NOT (e->>'active')::BOOLEAN ELSE false END AS gone FROM a"""

# ---- runs and scores

RUNS = {"k": K, "strategy_id": case(K, "'s1'", "'s2'", "'s3'", "''"), "run_id": case(K, "'R0'", "'R1'"), "group_name": case(K, "'issues'", "'files'", "'mixed'", "'other'"), "question_id": f"'Q' || {K} % 12", "score_0_to_100": case(K, "'80.5'", "'x'", "'60'", "''", "'71.25'"),
        "has_relevant_doc_top1": f"{K} % 2", "has_relevant_doc_top3": "1", "final_answer_correct": f"{K} % 3 % 2", "hallucination": case(K, "'0'", "'1'", "''"), "latency_seconds": f"{K} % 100 / 10"}


def strategy_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answers.of_run(made(spark, sf_dir, "orders", RUNS), run_id="R0").where(answers.is_evaluated()).where("strategy_id <> ''")
    flags = rows.withColumn("hallucination", F.col("hallucination").cast("int")).withColumn("latency_seconds", F.col("latency_seconds").cast("double"))
    scores = quality.strategy_scores(flags, "strategy_id", "has_relevant_doc_top1", "has_relevant_doc_top3", "final_answer_correct", "hallucination", "latency_seconds")
    ranked = answers.best_first(scores, "strategy_id")
    return ranked.select("strategy_id", F.round("top1", 6).alias("top1"), F.round("answer", 6).alias("answer"), F.round("hallucination", 6).alias("hallucination"), F.round("latency", 6).alias("latency"), F.round("score", 6).alias("score"))


STRATEGY_RANKING = f"""WITH i AS ({made_sql("orders", RUNS)}), r AS (SELECT *, latency_seconds::DOUBLE AS lat FROM i WHERE run_id = 'R0' AND hallucination <> '' AND strategy_id <> ''), e AS (SELECT min(lat) AS lo, max(lat) AS hi FROM r),
m AS (SELECT strategy_id, avg(has_relevant_doc_top1) AS a, avg(has_relevant_doc_top3) AS b, avg(final_answer_correct) AS c, avg(hallucination::INT) AS d, avg(lat) AS l FROM r GROUP BY 1)
SELECT strategy_id, round(a, 6) AS top1, round(c, 6) AS answer, round(d, 6) AS hallucination, round(l, 6) AS latency, round(0.40::DOUBLE * a + 0.20::DOUBLE * b + 0.35::DOUBLE * c - 0.15::DOUBLE * d - 0.05::DOUBLE * (l - lo) / greatest(hi - lo, 1e-9::DOUBLE), 6) AS score FROM m, e"""


def scope_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean online score of all questions and of each group, in the order of a report, with the first and last question by number."""
    rows = answers.online_scores(made(spark, sf_dir, "orders", RUNS))
    measures = {"n": F.count("online_score_0_to_100"), "online_avg": F.bround(F.avg("online_score_0_to_100"), 2), "first_question": F.min_by("question_id", answers.question_order(F.col("question_id"))), "last_question": F.max_by("question_id", answers.question_order(F.col("question_id")))}
    return quality.scoped(rows, "group_name", measures).withColumn("place", answers.scope_order(F.col("scope"))).orderBy("place", "scope")


SCOPE_REPORT = f"""WITH i AS (SELECT *, try_cast(nullif(score_0_to_100, '') AS DOUBLE) AS s, CAST(question_id[2:] AS INT) AS q FROM ({made_sql("orders", RUNS)})), g AS (SELECT group_name AS scope, * FROM i UNION ALL SELECT 'global', * FROM i)
SELECT count(s) AS n, round_even(avg(s), 2) AS online_avg, arg_min(question_id, q) AS first_question, arg_max(question_id, q) AS last_question, scope, CASE scope WHEN 'global' THEN 0 WHEN 'issues' THEN 1 WHEN 'files' THEN 2 WHEN 'mixed' THEN 3 ELSE 99 END AS place FROM g GROUP BY scope"""

# ---- cleaning

SOURCES = {
    "k": K, "file_type": case(K, "'release_notes'", "'root_readme'", "'driver_source'", "'repo_metadata'", "'documentation_pdf'", "'other'", "'cmsis_source'"), "path": case(K, "'a/x.html'", "'b/y.c'", "'c/z.md'", "'d/w.xml'", "'Include/stm32f4xx.h'", "'e/p.json'"),
    "text": case(K, f"'<p>a&amp;b ' || {K} || '</p><!--x-->'", "'![b](https://img.shields.io/x) ![i](u.png) [t]()'", "'  two  ' || chr(10) || chr(10) || chr(10) || chr(10) || 'lines '", f"'<package><name> N' || {K} || '</name><version>1.2</version></package>'", "''",
                 "'/* plain */' || chr(10) || 'int a;' || chr(10) || '// Copyright x' || chr(10) || 'b;'",
                 "'typedef enum { A_IRQn = 1, B_IRQn } IRQn_Type;' || chr(10) || '#define TIM_BASE (0x40)' || chr(10) || ' #define SPI_BASE   4' || chr(10) || '#define TIM_Pos 1' || chr(10) || 'typedef struct { int CR1; int CR2; } TIM_TypeDef;' || chr(10) || repeat('x', 100000)", "'null'"),
}


def cleaned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = made(spark, sf_dir, "orders", SOURCES).select("k", "file_type", text.clean_by_type(F.col("text"), F.col("file_type"), F.col("path")).alias("clean"))
    return out.select("k", F.length("clean").alias("n"), F.substring("clean", 1, 400).alias("head"), F.md5("clean").alias("clean_md5"))


_SUFFIX = "regexp_extract(lower(path), '^.+(\\.[^.]+)$', 1)"
_TRIM = "regexp_replace(regexp_replace({}, '^\\s+', ''), '\\s+$', '')"
_MD = _TRIM.format("regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '!\\[[^\\]]*\\]\\(https?://img\\.shields\\.io[^)]*\\)', '', 'g'), '!\\[[^\\]]*\\]\\([^)]+\\)', '[image removed]', 'g'), '\\[([^\\]]+)\\]\\(\\)', '\\1', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
_MD = _MD.replace("text, '!", "regexp_replace(text, '(?i)<(br|hr|img|div|span|center|p)\\b[^>]*/?>', '', 'g'), '!")
_CODE = _TRIM.format("regexp_replace(regexp_replace(text, '(?im)^\\s*(\\*|//).*(?:Copyright|All rights reserved|Licensed under|SPDX-License|Permission is hereby).*$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
_HTML = "array_to_string(list_filter(list_transform(string_split(regexp_replace(replace(regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '<[^>]+>', ' ', 'g'), '&amp;', '&'), '[ \\t]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10))"
_XML = f"CASE WHEN contains(text, '<name>') THEN 'name: ' || trim(regexp_extract(text, '<name>(.*?)</name>', 1)) || chr(10) || 'version: ' || regexp_extract(text, '<version>(.*?)</version>', 1) ELSE {_HTML} END"
_HEADER = """'/* CMSIS Device Header — Filtered for RAG relevance */' || chr(10) || '/* Original: ' || format('{:,}', length(text)) || ' chars, 3 #defines */' || chr(10) || '/* Kept: IRQ enum, 2 base addresses, 1 peripheral structs */' || chr(10) || '/* Full file: see GitHub link for complete register map */' || chr(10)
  || '/* ===== Interrupt Number Definition ===== */' || chr(10) || chr(10) || 'typedef enum { A_IRQn = 1, B_IRQn } IRQn_Type;' || chr(10) || chr(10) || chr(10) || '/* ===== Peripheral Base Addresses ===== */' || chr(10) || chr(10) || '#define TIM_BASE (0x40)' || chr(10) || '#define SPI_BASE   4' || chr(10) || chr(10)
  || chr(10) || '/* ===== Peripheral Register Structures ===== */' || chr(10) || chr(10) || 'typedef struct { int CR1; int CR2; } TIM_TypeDef;'"""
_KINDS = "('driver_source', 'cmsis_source')"
CLEANED_FILES = f"""WITH i AS (SELECT *, {_SUFFIX} AS sfx FROM ({made_sql("orders", SOURCES)})), c AS (SELECT k, CASE WHEN text = '' THEN '' WHEN file_type = 'release_notes' AND sfx = '.html' THEN {_HTML} WHEN file_type = 'root_readme' THEN {_MD}
  WHEN file_type IN {_KINDS} AND path = 'Include/stm32f4xx.h' AND length(text) > 100000 THEN {_HEADER} WHEN file_type IN {_KINDS} AND sfx IN ('.c', '.h') THEN {_CODE} WHEN file_type IN ('driver_source', 'cmsis_source', 'release_notes', 'repo_metadata') AND sfx = '.md' THEN {_MD}
  WHEN file_type = 'repo_metadata' AND sfx = '.xml' THEN {_XML} WHEN file_type = 'repo_metadata' AND sfx = '.json' THEN CASE WHEN text = 'null' THEN '' ELSE text[:2000] END WHEN file_type = 'documentation_pdf' THEN {_TRIM.format("regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')")} ELSE {_TRIM.format("text")} END AS clean FROM i)
SELECT k, length(clean) AS n, clean[:400] AS head, md5(clean) AS clean_md5 FROM c"""


LINES = {"doc_id": "doc_id", "source": "source", "text": "text || chr(10) || " + case("doc_id", "'#define TIM_CR1_Pos (4U)'", "'// SPDX-License-Identifier: MIT'", "'![x](u.png) a'", "'<div class=x><b>ok</b></div>'", "'/* ============= */'", "'signal line'") + " || chr(10) || '   '"}


def signal_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.signal_density(made(spark, sf_dir, "documents", LINES), "text", "source")


def noise_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = made(spark, sf_dir, "documents", LINES).select(F.explode(F.split(rules.text_of("text"), "\n")).alias("line"))
    return lines.groupBy(F.coalesce(quality.noise_reason(F.col("line")), F.lit("signal")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_NOISE = """CASE WHEN s = '' THEN 'empty' WHEN regexp_matches(s, '^#define\\s+\\w+_(Pos|Msk|\\d+)\\b') THEN 'cmsis_bit_macro' WHEN regexp_matches(s, '(?i)(copyright|all rights reserved|licensed under|spdx|permission is hereby)') THEN 'license_or_legal'
  WHEN regexp_matches(s, '!\\[[^\\]]*\\]\\([^)]+\\)') THEN 'markdown_image_or_badge' WHEN regexp_matches(s, '<[^>]+>') AND length(trim(regexp_replace(s, '<[^>]+>', '', 'g'))) <= greatest(8, length(s) // 4) THEN 'html_structure'
  WHEN regexp_matches(s, '^[\\s/*#_=\\-]{12,}$') THEN 'ascii_banner' ELSE 'signal' END"""
_LINES = f"""WITH i AS ({made_sql("documents", LINES)}), l AS (SELECT source, regexp_replace(regexp_replace(unnest(string_split(text, chr(10))), '^\\s+', ''), '\\s+$', '') AS s FROM i WHERE text IS NOT NULL), r AS (SELECT *, {_NOISE} AS reason, length(s) AS n FROM l)"""
SIGNAL_DENSITY = (
    _LINES
    + """, g AS (SELECT coalesce(source, 'other') AS scope, * FROM r WHERE s <> '' UNION ALL SELECT 'all', * FROM r WHERE s <> '') SELECT scope, CAST(sum(n) AS BIGINT) AS total_chars, CAST(coalesce(sum(n) FILTER (reason = 'signal'), 0) AS BIGINT) AS signal_chars, count(*) AS total_lines, count(*) FILTER (reason = 'signal') AS signal_lines,
  round(coalesce(sum(n) FILTER (reason = 'signal'), 0) / sum(n), 6) AS density_chars, round(count(*) FILTER (reason = 'signal') / count(*), 6) AS density_lines FROM g GROUP BY 1"""
)

# ---- similarity

STOP = "('the','and','for','with','that','this','from','into','when','then','than','have','has','had','was','were','are','is','be','been','being','will','would','can','could','should','may','might','not','you','your','they','their','them','our','nous','vous','avec','sans','dans','pour','sur','par','les','des','une','est','sont','été','être','cela','ceci','comme','plus','moins','very','also','image','description','text','figure','technical','issue','github','url','none')"
NEG = "('not','no','never','without','cannot','failed','fail','fails','error','errors','missing','none','disabled','disable','wrong','pas','sans','jamais','erreur','echec','manquant')"
POS = "('works','working','ok','fixed','resolved','success','enabled','available','correct','valid','supported','stable','fonctionne','corrige','actif')"
_TOKS = f"list_filter(regexp_extract_all(lower(coalesce({{}}, '')), '[a-z][a-z0-9_\\-/]{{{{2,}}}}'), lambda x: x NOT IN {STOP})"
CLASSES = ((0.95, "EXCELLENT"), (0.85, "BON"), (0.70, "ACCEPTABLE"))
#: Words of a finding that turns are given, so that both polarities occur.
SAID = {"conv_id": "conv_id", "turn": "turn", "role": "role", "said": "text || " + case("conv_id", "''", "case when role = 'user' then ' the timer works and is fixed' else ' the timer fails with an error' end", "case when role = 'user' then ' clock error again' else ' clock error again' end", "' it is supported and stable'")}


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "conversations", SAID)
    ask = rows.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("said").alias("ctx"))
    both = rows.where("role = 'assistant'").join(ask, ["conv_id", "turn"])
    told = similarity.semantic_lite(both, ["conv_id", "turn"], "said", "ctx")
    told = told.select("conv_id", "turn", "semantic", F.struct(similarity.tokens(F.col("said")).alias("a"), similarity.tokens(F.col("ctx")).alias("c")).alias("t"))
    scores = rules.let(F.col("t"), lambda t: F.struct(similarity.overlap_ratio(t["a"], t["c"]).alias("lexical"), similarity.contradiction(t["c"], t["a"]).alias("against")))
    rows = told.select("conv_id", "turn", "semantic", scores.alias("s")).select("conv_id", "turn", "s.lexical", "semantic", "s.against")
    final = F.round(similarity.coherence(F.col("lexical"), F.col("semantic"), F.col("against")), 6)
    return rows.withColumn("coherence_score", final).withColumn("reliability_class", score_band(F.col("coherence_score"), CLASSES, "INSUFFISANT"))


def grounding_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each assistant turn against the user turn before it: tokens, trigrams, polarity, and the class of the score."""
    return _turns(spark, sf_dir).select("conv_id", "turn", *(F.round(c, 6).alias(c) for c in ("lexical", "semantic", "against")), "coherence_score", "reliability_class")


def coherence_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir).withColumn("source", F.when(F.col("conv_id") % 2 == 0, "issue_image").otherwise("pdf_figure")).withColumn("flag_low_coherence", (F.col("coherence_score") < 0.3).cast("int"))
    return quality.coherence_summary(rows)


_TURNS = f"""WITH i AS ({made_sql("conversations", SAID)}), p AS (SELECT a.conv_id, a.turn, a.said AS a, u.said AS c FROM i a JOIN i u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE a.role = 'assistant' AND u.role = 'user'),
t AS (SELECT *, {_TOKS.format("a")} AS ta, {_TOKS.format("c")} AS tc, trim(regexp_replace(lower(coalesce(a, '')), '\\s+', ' ', 'g')) AS na, trim(regexp_replace(lower(coalesce(c, '')), '\\s+', ' ', 'g')) AS nc FROM p),
n AS (SELECT *, len(list_distinct(ta)) AS ua, len(list_distinct(tc)) AS uc, len(list_intersect(list_distinct(ta), list_distinct(tc))) AS shr, len(list_filter(ta, lambda x: x IN {POS})) - len(list_filter(ta, lambda x: x IN {NEG})) AS da, len(list_filter(tc, lambda x: x IN {POS})) - len(list_filter(tc, lambda x: x IN {NEG})) AS dc,
  list_transform(range(1, length(na) - 1), lambda i: na[i : i + 2]) AS ga, list_transform(range(1, length(nc) - 1), lambda i: nc[i : i + 2]) AS gc FROM t),
xa AS (SELECT conv_id, turn, g, count(*) AS n FROM (SELECT conv_id, turn, unnest(ga) AS g FROM n) GROUP BY ALL), xc AS (SELECT conv_id, turn, g, count(*) AS n FROM (SELECT conv_id, turn, unnest(gc) AS g FROM n) GROUP BY ALL),
qa AS (SELECT conv_id, turn, sqrt(sum(n * n)) AS q FROM xa GROUP BY ALL), qc AS (SELECT conv_id, turn, sqrt(sum(n * n)) AS q FROM xc GROUP BY ALL), dt AS (SELECT xa.conv_id, xa.turn, sum(xa.n * xc.n) AS d FROM xa JOIN xc USING (conv_id, turn, g) GROUP BY ALL),
o AS (SELECT n.*, CASE WHEN ua = 0 THEN 0.0::DOUBLE ELSE shr / ua END AS lex, CASE WHEN ua + uc = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, 0.7::DOUBLE * shr / (ua + uc - shr) + 0.3::DOUBLE * coalesce(d / (qa.q * qc.q), 0)) END AS sem,
  CASE WHEN len(ta) = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, abs(da) / len(ta) * 5.0) END AS ma, CASE WHEN len(tc) = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, abs(dc) / len(tc) * 5.0) END AS mc
  FROM n LEFT JOIN qa USING (conv_id, turn) LEFT JOIN qc USING (conv_id, turn) LEFT JOIN dt USING (conv_id, turn)),
g AS (SELECT *, CASE WHEN ua = 0 THEN 0.0::DOUBLE WHEN sign(da) * sign(dc) = -1 AND lex >= 0.2 THEN least(1.0::DOUBLE, 0.6::DOUBLE * lex + 0.4::DOUBLE * (ma + mc) / 2) WHEN lex < 0.1 THEN 0.0::DOUBLE ELSE 0.15::DOUBLE * lex END AS ag FROM o),
s AS (SELECT conv_id, turn, lex, sem, ag, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (0.4::DOUBLE * lex + 0.6::DOUBLE * sem) * (1.0 - least(1.0::DOUBLE, 0.8::DOUBLE * ag)))), 6) AS sc FROM g),
b AS (SELECT *, CASE WHEN sc >= 0.95 THEN 'EXCELLENT' WHEN sc >= 0.85 THEN 'BON' WHEN sc >= 0.7 THEN 'ACCEPTABLE' ELSE 'INSUFFISANT' END AS cls FROM s)
"""
GROUNDING = _TURNS + "SELECT conv_id, turn, round(lex, 6) AS lexical, round(sem, 6) AS semantic, round(ag, 6) AS against, sc AS coherence_score, cls AS reliability_class FROM b"
BY_SOURCE = (
    _TURNS
    + """SELECT CASE WHEN conv_id % 2 = 0 THEN 'issue_image' ELSE 'pdf_figure' END AS source, count(*) AS n, count(*) FILTER (sc < 0.3) AS low_coherence, round_even(count(*) FILTER (sc < 0.3) / count(*), 4) AS low_rate, round_even(avg(sc), 4) AS avg_score,
  count(*) FILTER (cls = 'EXCELLENT') AS "EXCELLENT", count(*) FILTER (cls = 'BON') AS "BON", count(*) FILTER (cls = 'ACCEPTABLE') AS "ACCEPTABLE", count(*) FILTER (cls = 'INSUFFISANT') AS "INSUFFISANT" FROM b GROUP BY 1"""
)


def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items against documents, by language block: share of an item's tokens in a document, and Jaccard, of pairs from a half up.

    An item takes part in each block. Pairs are counted over their common tokens, so none without one is formed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.array_distinct(similarity.tokens(F.col("text"))).alias("t"))
    items = table(spark, sf_dir, "benchmark").select("item_id", F.array_distinct(similarity.tokens(F.col("text"))).alias("t"))
    left = items.select("item_id", F.size("t").alias("ni"), F.explode("t").alias("w"))
    right = docs.select("doc_id", "lang", F.size("t").alias("nd"), F.explode("t").alias("w"))
    met = left.join(right, "w").groupBy("item_id", "lang", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("ni").alias("ni"), F.first("nd").alias("nd"))
    kept = met.where(F.col("n") * 2 >= F.col("ni"))
    return kept.select("item_id", "lang", "doc_id", F.round(F.col("n") / F.col("ni"), 6).alias("overlap"), F.round(F.col("n") / (F.col("ni") + F.col("nd") - F.col("n")), 6).alias("jaccard"))


BENCHMARK_OVERLAP = f"""WITH d AS (SELECT doc_id, lang, list_distinct({_TOKS.format("text")}) AS t FROM documents), b AS (SELECT item_id, list_distinct({_TOKS.format("text")}) AS t FROM benchmark), x AS (SELECT item_id, lang, doc_id, len(list_intersect(b.t, d.t)) AS n, len(b.t) AS ni, len(d.t) AS nd FROM b, d)
SELECT item_id, lang, doc_id, round(n / ni, 6) AS overlap, round(n / (ni + nd - n), 6) AS jaccard FROM x WHERE n > 0 AND 2 * n >= ni"""


def _valid_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.length(rules.text_of("text")) >= 100)
    return docs.select("doc_id", "source", similarity.titled(F.col("lang"), F.col("text")).alias("body"))


def tfidf_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related documents of a source by terms of any script, valid ones alone, the 5000 most frequent terms of a source."""
    return similarity.related(_valid_docs(spark, sf_dir), "source", "doc_id", "body", pattern=similarity.WORD, most_terms=5000)


TFIDF_ISSUES = r"""
WITH d AS (SELECT doc_id, source, coalesce(lang, '') || chr(10) || text AS body FROM documents WHERE length(coalesce(text, '')) >= 100), t AS (SELECT source AS block, doc_id AS id, unnest(regexp_extract_all(lower(body), '[\p{L}\p{N}_]{2,}')) AS term FROM d),
tf AS (SELECT block, id, term, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT block, term, count(*) AS df, sum(tf) AS a FROM tf GROUP BY block, term QUALIFY row_number() OVER (PARTITION BY block ORDER BY a DESC, encode(term)) <= 5000), n AS (SELECT source AS block, count(*) AS n FROM d GROUP BY 1),
r AS (SELECT tf.block, id, tf.term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN df ON tf.block = df.block AND tf.term = df.term JOIN n ON n.block = tf.block), m AS (SELECT block, id, sqrt(sum(w * w)) AS norm FROM r GROUP BY ALL), u AS (SELECT r.block, r.id, term, w / norm AS w FROM r JOIN m ON r.block = m.block AND r.id = m.id),
s AS (SELECT a.id AS i, b.id AS j, sum(a.w * b.w) AS s FROM u a JOIN u b ON a.block = b.block AND a.term = b.term AND a.id <> b.id GROUP BY ALL HAVING sum(a.w * b.w) >= 0.4)
SELECT i AS doc_id, j AS related, round(s, 6) AS sim, CAST(row_number() OVER (PARTITION BY i ORDER BY round(s, 6) DESC, j) AS INT) AS rank FROM s QUALIFY rank <= 3"""


def file_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as queries over documents with their source and language as path and type."""
    docs = table(spark, sf_dir, "documents").select("doc_id", similarity.headed(F.col("source"), F.col("lang"), F.col("text")).alias("body"))
    return similarity.search(table(spark, sf_dir, "benchmark"), "item_id", "text", docs, "doc_id", "body", pattern=similarity.WORD)


FILE_SEARCH = r"""
WITH t AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(coalesce(source, '') || chr(10) || '[' || coalesce(lang, '') || ']' || chr(10) || coalesce(text, '')), '[\p{L}\p{N}_]{2,}')) AS term FROM documents), tf AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1), dw AS (SELECT id, tf.term, tf * idf AS w FROM tf JOIN idf ON tf.term = idf.term), dn AS (SELECT id, sqrt(sum(w * w)) AS dn FROM dw GROUP BY 1),
qt AS (SELECT item_id AS q, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}')) AS term FROM benchmark), qf AS (SELECT q, term, count(*) AS tf FROM qt GROUP BY ALL), qw AS (SELECT q, qf.term, tf * idf AS qw FROM qf JOIN idf ON qf.term = idf.term), qn AS (SELECT q, sqrt(sum(qw * qw)) AS qn FROM qw GROUP BY 1),
x AS (SELECT qw.q, dw.id, round(sum(qw * w) / (any_value(dn) * any_value(qn)), 6) AS sim FROM qw JOIN dw ON qw.term = dw.term JOIN dn ON dn.id = dw.id JOIN qn ON qn.q = qw.q GROUP BY qw.q, dw.id)
SELECT q AS item_id, id AS doc_id, sim, CAST(row_number() OVER (PARTITION BY q ORDER BY sim DESC, id) AS INT) AS rank FROM x QUALIFY rank <= 5"""

# ---- splits, names, modules


def halved_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source in two parts, which are halved until they hold 20000 characters or one document; sources large enough alone."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.length(rules.text_of("text")).cast("long").alias("n"))
    sums = docs.groupBy("source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("docs")).where(audits.needs_split(F.col("size"), F.col("docs"), 30000, 8)).select("source")
    parts = windows.even_parts(docs.join(sums, "source", "left_semi"), ["doc_id"], 2, ["source"])
    return audits.halved(parts, ["source"], "part", "doc_id", F.col("n"), 20000).groupBy("source", "part", "sub_part").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("chars"), F.min("doc_id").alias("first_doc"))


HALVED_PARTS = """
WITH RECURSIVE d AS (SELECT source, doc_id, length(coalesce(text, '')) AS n FROM documents), k AS (SELECT source FROM d GROUP BY 1 HAVING sum(n) >= 30000 AND count(*) > 8), p AS (SELECT d.*, ntile(2) OVER (PARTITION BY source ORDER BY doc_id) AS part FROM d WHERE source IN (SELECT source FROM k)),
l AS (SELECT source, part, list(struct_pack(i := doc_id, n := n) ORDER BY doc_id) AS rows FROM p GROUP BY ALL),
h AS (SELECT source, part, rows, list_sum(list_transform(rows, lambda r: r.n)) AS s FROM l
  UNION ALL SELECT source, part, half, list_sum(list_transform(half, lambda r: r.n)) FROM (SELECT source, part, unnest([rows[:len(rows) // 2], rows[len(rows) // 2 + 1:]]) AS half FROM h WHERE s > 20000 AND len(rows) > 1)),
e AS (SELECT source, part, rows, s FROM h WHERE NOT (s > 20000 AND len(rows) > 1))
SELECT source, CAST(part AS INT) AS part, CAST(row_number() OVER (PARTITION BY source, part ORDER BY rows[1].i) - 1 AS INT) AS sub_part, len(rows) AS docs, CAST(s AS BIGINT) AS chars, rows[1].i AS first_doc FROM e"""

NAMES = {"id": K, "name": case(K, f"'DB_STready_H7_Issues_v' || {K} % 40", "'db_stready_h7_issues'", "'DB_STready_F4_Files'", f"'Other ' || {K} % 9"), "declared": f"'https://host/own/mod_' || {K} % 30 || '.git'", "repo": case(K, "'mod-1'", "'https://host/x/MOD_2.git'", "'mod_7'"),
         "component": case(K, "'spi'", "'none'", "''", "'Timer'"), "card": case(K, "'Context: component=adc, x'", "'Keywords: dma, DMA' || chr(10) || 'DMA and DMA'", "'nothing here'"), "mcu_series": case(K, "'h7'", "null", "''"), "path": case(K, "'x/stm32cubeg4/y'", "'x'"), "cube": case(K, "'STM32CubeF4'", "'other'")}


def source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = spark.createDataFrame([("DB_STready_H7_Issues",), ("db_stready_f4_files",), ("Other 3",), ("absent",)], "wanted string")
    return answers.source_ids(made(spark, sf_dir, "orders", NAMES), wanted).groupBy("wanted").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("newest"))


SOURCE_NAMES = f"""WITH i AS ({made_sql("orders", NAMES)}), w AS (SELECT unnest(['DB_STready_H7_Issues', 'db_stready_f4_files', 'Other 3', 'absent']) AS wanted)
SELECT wanted, count(*) AS n, max(id) AS newest FROM w JOIN i ON lower(name) = lower(wanted) OR (starts_with(lower(wanted), 'db_stready_') AND starts_with(lower(name), lower(wanted) || '_')) GROUP BY 1"""


def module_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "orders", NAMES)
    return audits.undeclared_modules(rows.select(F.col("declared").alias("url")).distinct(), rows.select("repo"))


MODULE_AUDIT = f"""WITH i AS ({made_sql("orders", NAMES)}) SELECT DISTINCT declared AS url, 'mod-' || regexp_extract(declared, '_(\\d+)', 1) AS slug FROM i WHERE regexp_extract(declared, '_(\\d+)', 1) NOT IN ('1', '2', '7')"""


def component_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "orders", NAMES).withColumn("labels", F.array().cast("array<string>"))
    found = audits.component_detection(rows, "component", "card").withColumn("series", audits.series_tag(F.col("mcu_series"), F.col("cube"), F.col("path")))
    return found.groupBy("split_component", "detection_source", "series").agg(F.count(F.lit(1)).alias("issues"))


COMPONENT_SOURCES = f"""WITH i AS ({made_sql("orders", NAMES)}), c AS (SELECT *, CASE component WHEN 'spi' THEN 'SPI' WHEN 'Timer' THEN 'TIM' END AS own, CASE WHEN starts_with(card, 'Context') THEN 'ADC' WHEN starts_with(card, 'Keywords') THEN 'DMA' END AS said FROM i)
SELECT coalesce(own, said, 'UNKNOWN') AS split_component, CASE WHEN own IS NOT NULL THEN 'component_field' WHEN said IS NOT NULL THEN 'st_ready_text' ELSE 'none' END AS detection_source,
  CASE WHEN mcu_series = 'h7' THEN 'H7' WHEN cube = 'STM32CubeF4' THEN 'F4' WHEN contains(path, 'stm32cubeg4') THEN 'G4' ELSE 'UNK' END AS series, count(*) AS issues FROM c GROUP BY ALL"""


def label_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents without a label and of labels without a document, over both whole tables."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return quality.missing(docs, labels, ["doc_id"]).withColumn("side", F.lit("missing")).unionByName(quality.missing(labels, docs, ["doc_id"]).withColumn("side", F.lit("extra")))


LABEL_DIFFERENCE = "SELECT doc_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'extra' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)"


def plain_issue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as issues: the plain document and its one chunk."""
    rows = table(spark, sf_dir, "documents").select(F.lit("STM32CubeH7").alias("repo"), F.col("doc_id").alias("issue_number"), F.col("source").alias("title"), F.array("lang", F.when(F.col("doc_id") % 3 == 0, F.lit("Bug")).otherwise(F.lit("x"))).alias("labels"), F.col("text").alias("clean_text"))
    return issues.whole_chunks(rows).select("id", F.md5("text").alias("text_md5"), F.col("metadata.mcu_series").alias("series"), F.col("metadata.is_confirmed_bug").alias("bug"), F.col("metadata.chunk_count").alias("chunks"))


PLAIN = "SELECT 'stm32cubeh7-issue-' || doc_id || '-0' AS id, md5(coalesce(text, '')) AS text_md5, 'H7' AS series, doc_id % 3 = 0 AS bug, 1 AS chunks FROM documents"

QUERIES = {
    "resolver_cards": resolver_cards, "resolver_summary": resolver_summary, "unlinked_audit": unlinked_audit, "unlinked_labels": unlinked_labels, "summary_coherence": summary_coherence, "artifact_counts": artifact_counts, "image_description_stats": image_description_stats, "image_texts": image_texts,
    "answer_extraction": answer_extraction, "strategy_ranking": strategy_ranking, "scope_report": scope_report, "cleaned_files": cleaned_files, "signal_density": signal_density, "noise_reasons": noise_reasons, "grounding_coherence": grounding_coherence, "coherence_by_source": coherence_by_source,
    "benchmark_overlap": benchmark_overlap, "tfidf_issues": tfidf_issues, "file_search": file_search, "halved_parts": halved_parts, "source_names": source_names, "module_audit": module_audit, "component_sources": component_sources, "label_difference": label_difference, "plain_issue_documents": plain_issue_documents,
}

ORACLE_SQL = {
    "resolver_cards": RESOLVER_CARDS, "resolver_summary": RESOLVER_SUMMARY, "unlinked_audit": UNLINKED_AUDIT, "unlinked_labels": UNLINKED_LABELS,
    "summary_coherence": "WITH c AS (SELECT o_orderstatus AS name, count(*) AS n FROM orders GROUP BY 1) SELECT name, CASE name WHEN 'P' THEN n + 1 WHEN 'O' THEN 0 ELSE n END AS stored, n AS counted, CASE WHEN name IN ('P', 'O') THEN 'warning' ELSE 'ok' END AS status FROM c",
    "artifact_counts": "SELECT 'issues_json' AS artifact, count(*) AS n FROM orders UNION ALL SELECT 'files_json', count(*) FROM part UNION ALL SELECT 'resolver_cases_json', count(*) FROM customer UNION ALL SELECT 'diagnostic_cards_json', count(*) FROM supplier",
    "image_description_stats": IMAGE_STATS, "image_texts": IMAGE_TEXTS, "answer_extraction": ANSWER_EXTRACTION, "strategy_ranking": STRATEGY_RANKING, "scope_report": SCOPE_REPORT, "cleaned_files": CLEANED_FILES, "signal_density": SIGNAL_DENSITY,
    "noise_reasons": _LINES + " SELECT reason, count(*) AS n FROM r GROUP BY 1", "grounding_coherence": GROUNDING, "coherence_by_source": BY_SOURCE, "benchmark_overlap": BENCHMARK_OVERLAP, "tfidf_issues": TFIDF_ISSUES, "file_search": FILE_SEARCH, "halved_parts": HALVED_PARTS,
    "source_names": SOURCE_NAMES, "module_audit": MODULE_AUDIT, "component_sources": COMPONENT_SOURCES, "label_difference": LABEL_DIFFERENCE, "plain_issue_documents": PLAIN,
}
