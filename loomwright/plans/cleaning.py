"""Cleaning and classification queries on pages, documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwright.functions import rules, text
from loomwright.operators import quality
from loomwright.operators.windows import ordered_distinct
from loomwright.session import table

#: Rules for the test data, in the form of the domain's own.
KINDS = (("english", (" the ", " and ", " of ")), ("german", (" der ", " die ", " und ")), ("french", (" le ", " les ", " des ")), ("spanish", (" el ", " los ", " las ")))
ORDERED = (r"[0-9]{3}-[0-9]{4}", r"[a-z0-9.]+@[a-z0-9.]+", r"https?://[a-z0-9./]+", r"[0-9]{4}")
MARKS = (r"@", r"https?:", r"[0-9]{3}", r"\|", r"!!", r"(?i)license")


def html_strip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("clean_text"))


def html_length_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = table(spark, sf_dir, "pages").select(F.length("html").alias("a"), F.length(text.strip_html(F.col("html"))).alias("b"))
    out = clean.agg(F.sum("a").alias("before"), F.sum("b").alias("after"))
    return out.withColumn("reduction_pct", quality.percent(F.col("before") - F.col("after"), F.col("before")))


def normalize_ws_first_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalize_whitespace(F.col("text"))).alias("ws"), text.first_sentence(F.col("text")).alias("sentence"))


def truncate_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_text(F.col("text"), 200).alias("t")).select("doc_id", "t.text", "t.truncated")


def slugify_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.slugify(F.regexp_replace(F.split(rules.text_of("text"), "\n")[0], "[^\\x00-\\x7F]", "?")).alias("slug"))


def thread_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text for each thread: the first user turn as body, later ones as comments, in turn order."""
    turns = table(spark, sf_dir, "conversations")
    first = turns.where("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("first"))
    rows = turns.join(first, "conv_id")
    later = F.when(F.col("turn") > F.col("first"), F.struct("turn", F.concat(F.lit("["), "role", F.lit(" - "), "turn", F.lit("]\n"), text.strip(rules.text_of("text"))).alias("c")))
    grouped = rows.groupBy("conv_id").agg(F.max(F.when(F.col("turn") == F.col("first"), text.strip(rules.text_of("text")))).alias("body"), F.sort_array(F.collect_list(later)).alias("comments"))
    comments = F.array_join(F.col("comments.c"), "\n\n")
    whole = F.concat(F.lit("Title: "), "conv_id", F.lit("\n\nBody:\n"), F.when(F.col("body") == "", "(no body)").otherwise(F.col("body")), F.when(F.size("comments") > 0, F.concat(F.lit("\n\nComments:\n"), comments)).otherwise(""))
    return grouped.select("conv_id", whole.alias("clean_text"))


def main_comment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = "\n\nComments:\n"
    t = thread_assembly(spark, sf_dir)
    at = F.instr("clean_text", mark)
    main = F.when(at > 0, F.substring(F.col("clean_text"), F.lit(1), at - 1)).otherwise(F.col("clean_text"))
    rest = F.when(at > 0, F.substring(F.col("clean_text"), at + len(mark), F.length("clean_text"))).otherwise("")
    return t.select("conv_id", main.alias("main"), F.length(rest).alias("comment_chars"))


def doc_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    bad = F.array_compact(F.array(F.when(F.col("toxic") == 1, F.lit("Invalid")), F.when(F.col("quality") == 0, F.lit("wontfix"))))
    v = rules.validity(F.col("text"), bad)
    return joined.select("doc_id", v.alias("v")).select("doc_id", "v.is_valid", F.array_join("v.reasons", ",").alias("reasons"))


def rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", rules.keyword_classes(F.col("text"), KINDS, "other").alias("kind"), rules.layer(F.col("text")).alias("layer"), rules.severity(F.col("text"), F.array().cast("array<string>")).alias("severity"))


def regex_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", rules.first_match(F.lower(F.col("text")), ORDERED).alias("found"), rules.board(F.col("text")).alias("board"), rules.component(F.col("text")).alias("component"))


def signal_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(rules.matching(F.col("text"), MARKS))
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("signals"), rules.ordered_case([(n >= 3, "high"), (n >= 2, "medium")], "low").alias("strength"))


def file_type_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^https?://[^/]*/?", "")
    return table(spark, sf_dir, "pages").select("page_id", rules.file_type(path).alias("file_type"), F.length(text.normalize_path(path)).alias("path_chars"))


def issue_number_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = rules.issue_numbers(F.concat(F.col("text"), F.lit(" #"), F.col("doc_id"), F.lit(" fixes 7, issues/12")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(numbers).cast("array<string>"), ",").alias("numbers"))


def ordered_distinct_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split(F.lower(F.regexp_replace(rules.text_of("text"), "[^\\x00-\\x7F]", "")), "[^a-z0-9]+"), lambda w: w != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(ordered_distinct(words, 12, fold_case=False), " ").alias("keywords"))


def keyword_match_any_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    pats = F.split(F.lit("the|of|and"), "\\|")
    t = F.lower(rules.text_of("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.exists(pats, lambda p: F.contains(t, p)).alias("any"), F.forall(pats, lambda p: F.contains(t, p)).alias("all"))


def rubric_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return turns.select("conv_id", "turn", rules.rubric(F.col("text")).alias("r")).select("conv_id", "turn", "r.cite", "r.work", "r.src", "r.total")


def rubric_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("role", rules.rubric(F.col("text"))["total"].alias("total"))
    return quality.scoped(turns, "role", {"answers": F.count(F.lit(1)), "points": F.sum("total")})


def markdown_and_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown cleaning and image collection on texts built around each document's id."""
    made = F.concat(F.lit("![b](https://img.shields.io/x) ![i]("), "doc_id", F.lit(".png) [t]()\n\n\n\n<br/>`x` <img src=\""), "doc_id", F.lit(".jpg\">"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_markdown(made).alias("md"), text.take_images(made).alias("i")).select("doc_id", "md", F.col("i.text").alias("body"), F.array_join("i.urls", ",").alias("urls"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(v).alias("with_k"), F.sum(v).alias("k_sum"), F.max(v).alias("k_max"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each assistant turn with the length of the user turn before it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumn("before", F.lag("role").over(w)).withColumn("asked", F.lag(F.length("text")).over(w))
    return turns.where("role = 'assistant' and before = 'user'").select("conv_id", "turn", "asked", F.length("text").alias("answered"))


_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_TEXT = "coalesce(text, '')"
_HTML = r"""
WITH a AS (SELECT page_id, html, regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g') AS t FROM pages),
b AS (SELECT page_id, html, regexp_replace(t, '(?is)(<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<head[^>]*>.*?</head>)', '', 'g') AS t FROM a),
c AS (SELECT page_id, html, regexp_replace(t, '<[^>]+>', ' ', 'g') AS t FROM b),
d AS (SELECT page_id, html, replace(replace(replace(replace(replace(replace(replace(t, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&quot;', '"'), '&#39;', ''''), '&apos;', '''') AS t FROM c),
e AS (SELECT page_id, html, string_split(regexp_replace(t, '[ \t]+', ' ', 'g'), chr(10)) AS ls FROM d),
f AS (SELECT page_id, html, array_to_string(list_filter(list_transform(ls, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10)) AS clean_text FROM e)
"""


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w.replace(chr(39), chr(39) * 2)}')" for w in words) + ")"


def _classes(column: str, groups, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any(column, words)} THEN '{label}'" for label, words in groups) + f" ELSE {default} END"


_RUBRIC = r"""
SELECT conv_id, turn, role, CASE WHEN na THEN 0 WHEN regexp_matches(t, '(?i)issue\s*#\s*\d+|#\d{1,5}\b') THEN 2 ELSE 0 END AS cite, CASE WHEN na THEN 0 WHEN regexp_matches(t, '\b(?:HAL|LL)_[A-Za-z0-9_]+\(') THEN 1 ELSE 0 END AS hal,
  CASE WHEN na THEN 0 WHEN regexp_matches(t, '(?m)```|^\s*\d+[).]\s') THEN 2 ELSE 0 END AS act, CASE WHEN na THEN 0 WHEN regexp_matches(t, '(?i)\bv\d+\.\d+(\.\d+)?\b|release[_ ]notes?') THEN 2 ELSE 0 END AS ver,
  CASE WHEN na THEN 0 WHEN regexp_matches(t, '(?i)\bregister|\bflag\b|cache|DCache|MPU|clean|invalidate|workaround|errata|align') THEN 2 ELSE 0 END AS work, CASE WHEN na THEN 0 WHEN regexp_matches(t, '(?i)readme|release_notes|\.c\b|\.h\b|issue\s*#|commit') THEN 1 ELSE 0 END AS src
FROM (SELECT conv_id, turn, role, coalesce(text, '') AS t, (coalesce(text, '') = '' OR regexp_matches(text, '(?i)request timeout|could not find enough reliable information')) AS na FROM conversations)
"""
_THREAD = rf"""
WITH f AS (SELECT conv_id, min(turn) AS first FROM conversations WHERE role = 'user' GROUP BY 1),
r AS (SELECT c.conv_id, turn, role, first, {_STRIP.format(_TEXT)} AS t FROM conversations c JOIN f ON c.conv_id = f.conv_id),
g AS (SELECT conv_id, max(CASE WHEN turn = first THEN t END) AS body, string_agg('[' || role || ' - ' || turn || ']' || chr(10) || t, chr(10) || chr(10) ORDER BY turn) FILTER (turn > first) AS comments FROM r GROUP BY 1),
h AS (SELECT conv_id, 'Title: ' || conv_id || chr(10) || chr(10) || 'Body:' || chr(10) || CASE WHEN body = '' THEN '(no body)' ELSE body END || CASE WHEN comments IS NULL THEN '' ELSE chr(10) || chr(10) || 'Comments:' || chr(10) || comments END AS clean_text FROM g)
"""

QUERIES = {
    "html_strip_pages": html_strip_pages, "html_length_reduction": html_length_reduction, "normalize_ws_first_sentence": normalize_ws_first_sentence, "truncate_marker": truncate_marker,
    "slugify_titles": slugify_titles, "thread_assembly": thread_assembly, "main_comment_split": main_comment_split, "doc_validity": doc_validity, "rule_classifier": rule_classifier, "regex_first_match": regex_first_match,
    "signal_count": signal_count, "file_type_by_path": file_type_by_path, "issue_number_extraction": issue_number_extraction, "ordered_distinct_cap": ordered_distinct_cap, "keyword_match_any_all": keyword_match_any_all,
    "rubric_score": rubric_score, "rubric_averages": rubric_averages, "markdown_and_images": markdown_and_images, "json_props_extract": json_props, "turn_pairs": turn_pairs,
}

ORACLE_SQL = {
    "html_strip_pages": _HTML + "SELECT page_id, clean_text FROM f",
    "html_length_reduction": _HTML + "SELECT sum(length(html)) AS before, sum(length(clean_text)) AS after, floor((before - after) * 1000 / before + 0.5) / 10 AS reduction_pct FROM f",
    "normalize_ws_first_sentence": rf"""WITH w AS (SELECT doc_id, trim(regexp_replace({_TEXT}, '\s+', ' ', 'g')) AS t FROM documents), e AS (SELECT *, length(regexp_extract(t, '^[^.!?]*[.!?]', 0)) AS n FROM w)
      SELECT doc_id, md5(t) AS ws, CASE WHEN n > 0 AND n <= 260 THEN t[1:n] ELSE rtrim(t[1:260]) END AS sentence FROM e""",
    "truncate_marker": f"SELECT doc_id, CASE WHEN length({_TEXT}) > 200 THEN rtrim(text[1:200], ' ') ELSE {_TEXT} END AS text, length({_TEXT}) > 200 AS truncated FROM documents",
    "slugify_titles": rf"""WITH a AS (SELECT doc_id, regexp_replace(lower(regexp_replace(string_split({_TEXT}, chr(10))[1], '[^\x00-\x7F]', '?', 'g')), '[^a-z0-9]+', '-', 'g') AS t FROM documents), b AS (SELECT doc_id, regexp_replace(t, '^-+|-+$', '', 'g')[1:80] AS t FROM a)
      SELECT doc_id, CASE WHEN t = '' THEN 'untitled' ELSE t END AS slug FROM b""",
    "thread_assembly": _THREAD + "SELECT * FROM h",
    "main_comment_split": _THREAD + """SELECT conv_id, CASE WHEN pos > 0 THEN clean_text[1:pos - 1] ELSE clean_text END AS main, CAST(CASE WHEN pos > 0 THEN length(clean_text) - pos - 11 ELSE 0 END AS INT) AS comment_chars
      FROM (SELECT *, instr(clean_text, chr(10) || chr(10) || 'Comments:' || chr(10)) AS pos FROM h)""",
    "doc_validity": r"""WITH j AS (SELECT d.doc_id, coalesce(text, '') AS t, coalesce(toxic = 1, false) OR coalesce(quality = 0, false) AS bad FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
      k AS (SELECT *, length(t) < 100 AS short, (bad OR length(t) < 100) AND length(t) >= 120 AND regexp_matches(t, '(?i)\bHAL_[A-Za-z0-9_]+\b|\bLL_[A-Za-z0-9_]+\b|\bDMA\b|\bstuck\s+busy\b|\bblocking\b|\bdeadlock\b|\btimeout\b|\bhardfault\b|\bhard\s+fault\b|\bcallback\b|\breproduc(e|ible|tion)\b') AS rescued FROM j)
      SELECT doc_id, rescued OR NOT (bad OR short) AS is_valid, CASE WHEN rescued THEN '' ELSE concat_ws(',', CASE WHEN bad THEN 'invalid_label' END, CASE WHEN short THEN 'short_text' END) END AS reasons FROM k""",
    "rule_classifier": f"SELECT doc_id, {_classes('lower(' + _TEXT + ')', KINDS, chr(39) + 'other' + chr(39))} AS kind, {_classes('upper(' + _TEXT + ')', rules.LAYERS, chr(39) + 'Other' + chr(39))} AS layer, {_classes('lower(' + _TEXT + ')', (('low', rules.LOW_WORDS), ('high', rules.HIGH_WORDS)), chr(39) + 'medium' + chr(39))} AS severity FROM documents",
    "regex_first_match": f"SELECT doc_id, coalesce({', '.join(f'nullif(regexp_extract(lower({_TEXT}), {chr(39)}{p}{chr(39)}, 0), {chr(39) * 2})' for p in ORDERED)}) AS found, coalesce({', '.join(f'nullif(regexp_extract(upper({_TEXT}), {chr(39)}{p}{chr(39)}, 0), {chr(39) * 2})' for p in rules.BOARDS)}) AS board, {_classes('lower(' + chr(39) + ' ' + chr(39) + ' || ' + _TEXT + ' || ' + chr(39) + ' ' + chr(39) + ')', rules.COMPONENTS, 'NULL')} AS component FROM documents",
    "signal_count": f"WITH s AS (SELECT doc_id, CAST({' + '.join(f'regexp_matches({_TEXT}, {chr(39)}{p}{chr(39)})::INT' for p in MARKS)} AS INT) AS signals FROM documents) SELECT doc_id, signals, CASE WHEN signals >= 3 THEN 'high' WHEN signals >= 2 THEN 'medium' ELSE 'low' END AS strength FROM s",
    "file_type_by_path": rf"""WITH p AS (SELECT page_id, regexp_replace(url, '^https?://[^/]*/?', '') AS raw, lower(regexp_replace(url, '^https?://[^/]*/?', '')) AS p FROM pages)
      SELECT page_id, CASE WHEN regexp_matches(p, '^documentations?/') AND p LIKE '%.pdf' THEN 'documentation_pdf' WHEN regexp_matches(p, 'release_notes|releasenotes') THEN 'release_notes' WHEN contains(p, 'projects/') THEN 'project_readme'
        WHEN regexp_matches(p, 'readme\.(md|txt)$') THEN CASE WHEN contains(p, '/documentation/') THEN 'doc_readme' ELSE 'root_readme' END WHEN p IN {rules.METADATA_FILES} THEN 'repo_metadata' WHEN p LIKE 'drivers/%' THEN 'driver_source'
        WHEN regexp_matches(p, '^(src|inc)/') THEN 'hal_driver_source' WHEN p LIKE 'middlewares/%' THEN 'middleware_source' WHEN p LIKE 'utilities/%' THEN 'utilities_content' WHEN p LIKE 'components/%' THEN 'bsp_component_source'
        WHEN regexp_matches(p, '^(include|source)/') THEN 'cmsis_source' WHEN regexp_matches(p, '^stm32[^/]*(-dk|-eval|-disco|nucleo)') THEN 'bsp_board_source' ELSE 'other' END AS file_type, CAST(length(regexp_replace(trim(p), '^/+', '')) AS INT) AS path_chars FROM p""",
    "issue_number_extraction": rf"""WITH t AS (SELECT doc_id, text || ' #' || doc_id || ' fixes 7, issues/12' AS t FROM documents)
      SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(list_concat(regexp_extract_all(t, '#(\d+)', 1), regexp_extract_all(t, '(?i)(?:issues|issue)/(\d+)', 1), regexp_extract_all(t, '(?i)\bissue\s*#?\s*(\d+)\b', 1), regexp_extract_all(t, '(?i)\b(?:fixe[sd]?|close[sd]?|resolve[sd]?)\s*:?\s*#?(\d+)\b', 1)), lambda x: TRY_CAST(x AS BIGINT)))), ',') AS numbers FROM t""",
    "ordered_distinct_cap": rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(regexp_replace({_TEXT}, '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents), p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
      f AS (SELECT doc_id, word, min(i) AS i FROM p GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f QUALIFY n <= 12) SELECT d.doc_id, coalesce(string_agg(word, ' ' ORDER BY n), '') AS keywords FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id""",
    "keyword_match_any_all": f"SELECT doc_id, {_any('lower(' + _TEXT + ')', ('the', 'of', 'and'))} AS \"any\", contains(lower({_TEXT}), 'the') AND contains(lower({_TEXT}), 'of') AND contains(lower({_TEXT}), 'and') AS \"all\" FROM documents",
    "rubric_score": f"SELECT conv_id, turn, cite, work, src, cite + hal + act + ver + work + src AS total FROM ({_RUBRIC}) WHERE role = 'assistant'",
    "rubric_averages": f"SELECT coalesce(role, 'global') AS scope, count(*) AS answers, CAST(sum(cite + hal + act + ver + work + src) AS BIGINT) AS points FROM ({_RUBRIC}) GROUP BY GROUPING SETS ((role), ())",
    "markdown_and_images": r"""SELECT doc_id, '[image removed] t' || chr(10) || chr(10) || '`x`' AS md, '![b](https://img.shields.io/x) ![i](' || doc_id || '.png) [t]()' || repeat(chr(10), 4) || '<br/>x [IMAGE ATTACHED]' AS body, doc_id || '.jpg' AS urls FROM documents""",
    "json_props_extract": "SELECT event_type, count(TRY_CAST(props->>'$.k' AS BIGINT)) AS with_k, CAST(sum(TRY_CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS k_sum, max(TRY_CAST(props->>'$.k' AS BIGINT)) AS k_max FROM events GROUP BY 1",
    "turn_pairs": "SELECT conv_id, turn, asked, answered FROM (SELECT conv_id, turn, role, CAST(length(text) AS INT) AS answered, lag(role) OVER w AS before, CAST(lag(length(text)) OVER w AS INT) AS asked FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'assistant' AND before = 'user'",
}
