"""Queries of paths, rules, cards and audits on support cases made from the test tables.

Inputs are SQL expressions over keys that both engines read, so that every class, tag and sentence occurs. The DuckDB side
states its lists and sentences itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import paths, rules
from loomwright.operators import audits, diagnostic, issues, resolver
from loomwright.session import table

Expressions = dict[str, str]


def made(spark: SparkSession, sf_dir: str, name: str, expressions: Expressions, where: str = "true") -> DataFrame:
    return table(spark, sf_dir, name).where(where).selectExpr(*(f"{e} AS {n}" for n, e in expressions.items()))


def made_sql(name: str, expressions: Expressions, where: str = "true") -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in expressions.items()) + f" FROM {name} WHERE {where}"


def case(key: str, *values: str) -> str:
    """CASE over key % number of values; values are SQL."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def listed(c: str | Column) -> Column:
    """The items of a comma-joined text."""
    return F.filter(F.split(c, ","), lambda x: x != "")


def bar(c: str | Column) -> Column:
    return F.array_join(c, "|")


K = "o_orderkey"

# ---- paths

PATHS = {
    "k": K,
    "path": case(K, f"'Projects/B' || {K} || '/Examples/ADC_' || {K} || '/readme.txt'", "'Projects/B/Src/main.c'", "'Release_Notes.html'", f"'Drivers/X/Release_Notes_v' || {K} || '.md'", "'README.md'", "'docs/README.md'",
                 f"'Documentation/UM' || {K} || '.pdf'", "'package.xml'", f"'Drivers/CMSIS/Include/stm32f4' || {K} || '.h'", "'stm32f429i-disco/board.c'", "'stm32l4xx/board.c'", f"'tools/gen' || {K} || '.py'",
                 "'Middlewares' || chr(92) || 'Net' || chr(92) || 'lwip.c'", "'Utilities/logo.bmp'", f"'out/files__part' || {K} || '.json'", "'.gitmodules'", "'by_series/H7/x/Examples'", "'/src/startup.s'"),
    "repo": case(K, "'Main_Repo'", "'https://host/owner/sub_driver.git'", "null"),
    "series": case(K, "null", "'SeriesA'"),
    "chars": f"{K} * 7919 % 200000",
}


def file_inclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("path")
    flags = {"project_readme": paths.is_project_readme(p), "release_notes": paths.is_release_notes(p), "top_readme": paths.is_top_readme(p), "doc_pdf": paths.is_documentation_pdf(p), "top_metadata": paths.is_top_metadata(p), "technical": paths.is_technical_source(p)}
    return made(spark, sf_dir, "orders", PATHS).select(
        "k", *(c.alias(n) for n, c in flags.items()), paths.is_wanted(p).alias("wanted"), paths.is_register_header(p, F.col("chars")).alias("header"), paths.is_split_part(p).alias("split_part"), paths.example_name(p).alias("example"),
        paths.series_folder(p).alias("series_folder"), paths.file_id(F.col("repo"), p).alias("file_id"), paths.repo_slug(F.col("repo")).alias("slug"), paths.delivery_path(F.col("series"), F.col("repo"), "files_json").alias("delivered"), rules.file_type(p).alias("file_type"),
    )


FILE_INCLUSION = r"""
WITH i AS (""" + made_sql("orders", PATHS) + r"""), s AS (SELECT *, replace(path, chr(92), '/') AS p FROM i),
a AS (SELECT *, list_filter(string_split(p, '/'), lambda x: x <> '') AS steps, string_split(p, '/') AS raw FROM s),
b AS (SELECT *, lower(steps[-1]) AS nm, lower(steps[1]) AS rt, regexp_extract(lower(steps[-1]), '^.+(\.[^.]+)$', 1) AS sfx FROM a),
c AS (SELECT *, sfx IN ('.md', '.txt', '.htm', '.html') AS doc, starts_with(nm, 'readme') AS rd, starts_with(nm, 'release_notes') AS rn, len(steps) AS n FROM b),
f AS (SELECT *, n >= 2 AND steps[1] = 'Projects' AND rd AND doc AS project_readme, rn AND doc AS release_notes, n = 1 AND rd AND doc AS top_readme, rt IN ('documentation', 'documentations') AND sfx = '.pdf' AS doc_pdf,
  n = 1 AND (nm IN ('.deliveryignore', '.gitmodules', 'code_of_conduct.md', 'contributing.md', 'license.md', 'security.md', 'sw_security_level.md', 'package.xml', 'sbom_cdx.json') OR ((rd OR rn) AND doc)) AS top_metadata,
  rd OR rn OR ((doc OR sfx IN ('.c', '.h', '.hpp', '.hh', '.s', '.asm', '.ld', '.mk', '.cmake', '.dox', '.rst', '.xml', '.json', '.yml', '.yaml', '.ini', '.cfg', '.conf', '.csv'))
    AND (n = 1 OR rt IN ('drivers', 'middlewares', 'utilities', 'components', 'include', 'source', 'inc', 'src') OR (starts_with(rt, 'stm32') AND (contains(rt, '-dk') OR contains(rt, '-eval') OR contains(rt, '-disco') OR contains(rt, 'nucleo'))))) AS technical,
  lower(coalesce(repo, '')) AS rp, lower(p) AS lp FROM c)
SELECT k, project_readme, release_notes, top_readme, doc_pdf, top_metadata, technical, project_readme OR release_notes OR top_readme OR doc_pdf OR top_metadata OR technical AS wanted,
  regexp_matches(nm, '^stm32[a-z0-9]+\.h$') AND chars > 100000 AS header, regexp_matches(nm, '__part[0-9]+\.json$') AS split_part,
  CASE WHEN list_position(raw, 'Examples') > 0 THEN raw[list_position(raw, 'Examples') + 1] END AS example, CASE WHEN list_position(raw, 'by_series') > 0 THEN raw[list_position(raw, 'by_series') + 1] ELSE 'unknown' END AS series_folder,
  rp || '-file-' || sha1(rp || ':' || regexp_replace(p, '^/+', ''))[:16] AS file_id, CASE WHEN repo IS NULL THEN '' WHEN contains(repo, '/') THEN 'sub-driver' ELSE 'main-repo' END AS slug,
  CASE WHEN series IS NOT NULL THEN 'seriesa/drivers/' ELSE '' END || rp || '/files_json' AS delivered,
  CASE WHEN regexp_matches(lp, '^documentations?/') AND ends_with(lp, '.pdf') THEN 'documentation_pdf' WHEN contains(lp, 'release_notes') OR contains(lp, 'releasenotes') THEN 'release_notes' WHEN contains(lp, 'projects/') THEN 'project_readme'
    WHEN regexp_matches(lp, 'readme\.(md|txt)$') AND contains(lp, '/documentation/') THEN 'doc_readme' WHEN regexp_matches(lp, 'readme\.(md|txt)$') THEN 'root_readme'
    WHEN lp IN ('code_of_conduct.md', 'contributing.md', 'license.md', 'security.md', 'sw_security_level.md', 'package.xml', 'sbom_cdx.json', '.deliveryignore', '.gitmodules') THEN 'repo_metadata' WHEN starts_with(lp, 'drivers/') THEN 'driver_source'
    WHEN regexp_matches(lp, '^(src|inc)/') THEN 'hal_driver_source' WHEN starts_with(lp, 'middlewares/') THEN 'middleware_source' WHEN starts_with(lp, 'utilities/') THEN 'utilities_content' WHEN starts_with(lp, 'components/') THEN 'bsp_component_source'
    WHEN regexp_matches(lp, '^(include|source)/') THEN 'cmsis_source' WHEN regexp_matches(lp, '^stm32[^/]*(-dk|-eval|-disco|nucleo)') OR (NOT contains(lp, '/') AND regexp_matches(lp, '^stm32.*\.(c|h|hpp|s|asm)$')) THEN 'bsp_board_source' ELSE 'other' END AS file_type
FROM f
"""

# ---- rules

RULES = {
    "k": K,
    "text": case(K, "'HAL_SPI_Init fails with FreeRTOS and a crash on nucleo-h743zi board, HAL_UART too'", "'How do I change the name of it'", "'Configure the clock configuration of LL_TIM'", "'lwIP drops packets over ethernet, watchdog reset after a while'",
                 "'Generated by STM32CubeMX for stm32h743 with a typo in the usb comment'", "'plain words only'", "'The adc reads nothing and dma stays stuck busy'", "''", "'CAN bus deadlock on STM32F407 with fdcan ' || repeat('x', 100)", "'documentation of usart'", "null") + " || ' '",
    "labels": case(K, "'Bug'", "'question,HAL'", "''", "'duplicate'", "'Doc'", "'internal bug tracker'", "'wontfix,bug'"),
}


def issue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, labels = F.col("text"), F.col("labels")
    rows = made(spark, sf_dir, "orders", RULES).withColumn("labels", F.split("labels", ","))
    valid = rules.validity(t, labels)
    return rows.select(
        "k", rules.issue_kind(t, labels).alias("kind"), rules.layer(t).alias("layer"), rules.severity(t, labels).alias("severity"), rules.board(t).alias("board"), rules.component(t).alias("component"), valid["is_valid"].alias("is_valid"), valid["rescued"].alias("rescued"),
        F.array_join(valid["reasons"], "|").alias("reasons"), rules.evidence_strength(t, F.arrays_overlap(rules.lower_all(labels), F.array(F.lit("bug"), F.lit("internal bug tracker"))), valid["is_valid"]).alias("strength"), diagnostic.normalized_series(F.get(labels, F.lit(0))).alias("as_series"),
    )


def _any(t: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({t}, '{w}')" for w in words) + ")"


_UP, _LOW, _PAD = "upper(t)", "lower(t)", "lower(' ' || t || ' ')"
_SIGNALS = (r"\bhal_[a-z0-9_]+\b", r"\bll_[a-z0-9_]+\b", r"\bdma\b", r"\bstuck\s+busy\b", r"\bblocking\b", r"\bdeadlock\b", r"\btimeout\b", r"\bhardfault\b|\bhard\s+fault\b", r"\bcallback\b", r"\breproduc(e|ible|tion)\b")
ISSUE_RULES = f"""
WITH i AS ({made_sql("orders", RULES)}), d AS (SELECT k, coalesce(text, '') AS t, string_split(labels, ',') AS l, list_transform(string_split(labels, ','), lambda x: lower(x)) AS ll FROM i),
r AS (SELECT *, len(list_intersect(ll, ['bug', 'internal bug tracker'])) > 0 AS bug, len(list_intersect(ll, ['invalid', 'duplicate', 'wontfix'])) > 0 AS bad, length(t) < 100 AS short,
  {" + ".join(f"CAST(regexp_matches(lower(t), '{p}') AS INT)" for p in _SIGNALS)} AS signals, len(regexp_extract_all(t, '\\b([A-Z]{{2,}}[A-Z0-9_\\-]{{1,}}|[A-Za-z]+_[A-Za-z0-9_]+)\\b')) AS anchors FROM d),
v AS (SELECT *, (bad OR short) AND length(t) >= 120 AND signals > 0 AS rescued FROM r), w AS (SELECT *, NOT (bad OR short) OR rescued AS is_valid FROM v)
SELECT k, CASE WHEN bug THEN 'bug_report' WHEN {_any(_LOW, "how to", "how do i")} OR list_contains(ll, 'question') THEN 'usage_question' WHEN {_any(_LOW, "configuration", "configure")} THEN 'configuration_help' ELSE 'other' END AS kind,
  CASE WHEN {_any(_UP, "HAL_", " HAL DRIVER", " HAL LIBRARY")} THEN 'HAL' WHEN {_any(_UP, "LL_", " LOW LAYER", "LOW-LAYER")} THEN 'LL'
    WHEN {_any(_UP, "LWIP", "FATFS", "FAT FS", "FREERTOS", "USB HOST", "USB DEVICE", "USBH_", "USBD_", "MIDDLEWARE", "TCP/IP", "TCP IP")} THEN 'Middleware' WHEN {_any(_UP, "CUBEMX", " MX_", "DEVICE CONFIGURATION TOOL")} THEN 'CubeMX' ELSE 'Other' END AS layer,
  CASE WHEN len(list_intersect(ll, ['documentation', 'doc', 'typo'])) > 0 OR {_any(_LOW, "documentation", "doc issue", "doc problem", "typo", "spelling", "example description", "minor issue")} THEN 'low'
    WHEN {_any(_LOW, "hardfault", "hard fault", "crash", "freeze", "frozen", "hang", "stuck", "blocking", "block forever", "deadlock", "data corruption", "corrupted data", "doesn''t start", "does not start", "cannot start", "no communication", "watchdog reset", "wdg reset", "reset loop", "infinite loop", "regression")} THEN 'high' ELSE 'medium' END AS severity,
  coalesce(nullif(regexp_extract(upper(t), 'NUCLEO-[A-Z0-9]+'), ''), nullif(regexp_extract(upper(t), 'STM32H7[0-9A-Z]+'), ''), nullif(regexp_extract(upper(t), 'STM32F4[0-9A-Z]+'), ''), nullif(regexp_extract(upper(t), 'STM32F7[0-9A-Z]+'), '')) AS board,
  CASE WHEN {_any(_PAD, "ethernet", " lan ", " eth ")} THEN 'ETH' WHEN {_any(_PAD, "usb")} THEN 'USB' WHEN {_any(_PAD, "adc")} THEN 'ADC' WHEN {_any(_PAD, " dma ")} THEN 'DMA' WHEN {_any(_PAD, "uart", "usart")} THEN 'UART'
    WHEN {_any(_PAD, "fdcan", " bxcan", " hal_can_", " can1", " can2", "can bus", "canfd")} THEN 'CAN' WHEN {_any(_PAD, "freertos")} THEN 'FREERTOS' END AS component,
  is_valid, rescued, CASE WHEN rescued THEN '' ELSE array_to_string(list_filter([CASE WHEN bad THEN 'invalid_label' END, CASE WHEN short THEN 'short_text' END], lambda x: x IS NOT NULL), '|') END AS reasons,
  CASE WHEN NOT is_valid THEN 'low' WHEN bug AND (anchors >= 2 OR signals >= 2) THEN 'high' WHEN anchors >= 2 OR signals >= 2 THEN 'medium' ELSE 'low' END AS strength, nullif(upper(trim(l[1])), '') AS as_series FROM w
"""

# ---- cards of issues and files

_BODY = case(K, "'The HAL_SPI_Transmit_DMA call with 2 bytes is stuck busy. A small transfer never ends'", "'Thanks a lot'", "'Build fails with GCC_ARM after upgrade to STM32CubeF4 v1.2.3! See TIM_CR1'", "'[IMAGE ATTACHED] The clock of UART_1 stops'", "''")
_COMMENTS = case(K, f"chr(10) || chr(10) || 'Comments:' || chr(10) || '[anna - 2020-01-02T00:00:00]' || chr(10) || 'It works with PR ' || {K} || '. Ok' || chr(10) || 'Best regards,' || chr(10) || chr(10) || chr(10) || 'Anna'", "''", "chr(10) || chr(10) || 'Comments:' || chr(10) || 'regards,'")
ISSUES = {
    "k": K, "repo": "'RepoA'", "mcu_series": case(K, "'H7'", "null", "'F4'"), "board": case(K, "null", "'NUCLEO-H743ZI'"), "component": case(K, "'SPI'", "'Unknown'", "null", "'ADC'"), "layer": case(K, "'HAL'", "'Other'"),
    "issue_kind": case(K, "'bug_report'", "'other'", "'usage_question'"), "severity": case(K, "'high'", "'low'", "null"), "evidence_strength": case(K, "'high'", "'medium'", "'low'"), "rescue_applied": f"{K} % 2 = 0", "state": "'open'", "issue_number": K,
    "issue_title": case(K, f"'SPI  DMA blocks in  callback ' || {K}", "'Compile error. After upgrade'", "''", "'Clock timeout'"), "labels": case(K, "'bug,spi'", "''", "'HAL, spi,question'"), "github_url": case(K, f"'https://x/i/' || {K}", "null", f"'https://x/i/' || {K}"),
    "clean_text": f"CASE WHEN {K} % 7 = 0 THEN null ELSE 'Title: t' || {K} || chr(10) || chr(10) || 'Body:' || chr(10) || {_BODY} || {_COMMENTS} END",
}


def _issue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, "orders", ISSUES).withColumn("labels", listed("labels"))


def issue_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _issue_rows(spark, sf_dir).withColumn("text", issues.issue_text(60))
    return rows.select("k", "text", issues.issue_markdown(F.col("text"), "Card").alias("markdown"), issues.markdown_name(F.col("issue_number"), F.col("issue_title")).alias("file"))


def _ws(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


def _first(c: str, most: int) -> str:
    """First sentence of a text that is normalised already."""
    return f"(CASE WHEN length(regexp_extract({c}, '^[^.!?]*[.!?]')) BETWEEN 1 AND {most} THEN regexp_extract({c}, '^[^.!?]*[.!?]') ELSE rtrim({c}[:{most}]) END)"


def _few(items: str, most: int) -> str:
    norm = f"list_filter(list_transform({items}, lambda x: {_ws('x')}), lambda x: x <> '')"
    return f"list_filter({norm}, lambda x, i: list_position(list_transform({norm}, lambda y: lower(y)), lower(x)) = i)[:{most}]"


def _none(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'None')"


ISSUE_CARDS = f"""
WITH i AS ({made_sql("orders", ISSUES)}), a AS (SELECT *, trim(regexp_replace(coalesce(clean_text, ''), '^Title:\\s*[^\\n]*\\n\\nBody:\\n', ''), ' ' || chr(10)) AS bare FROM i),
b AS (SELECT *, CASE WHEN contains(bare, chr(10) || chr(10) || 'Comments:' || chr(10)) THEN string_split(bare, chr(10) || chr(10) || 'Comments:' || chr(10))[1] ELSE bare END AS main,
  CASE WHEN contains(bare, chr(10) || chr(10) || 'Comments:' || chr(10)) THEN string_split(bare, chr(10) || chr(10) || 'Comments:' || chr(10))[2] ELSE '' END AS com FROM a),
c AS (SELECT *, {_ws("main")} AS m, trim(array_to_string(list_filter(string_split(com, chr(10)), lambda x: NOT regexp_matches(trim(x), '^\\[[A-Za-z0-9_-]+\\s-\\s\\d{{4}}-\\d{{2}}-\\d{{2}}T') AND lower(trim(x)) NOT IN ('with regards,', 'best regards,', 'regards,', 'thanks,')), chr(10)), ' ' || chr(10)) AS kept FROM b),
d AS (SELECT *, {_ws("trim(regexp_replace(kept, chr(10) || '{3,}', chr(10) || chr(10), 'g'))[:60]")} AS cm FROM c),
e AS (SELECT *, trim(regexp_replace(CASE WHEN cm <> '' THEN cm ELSE m END, '\\[IMAGE ATTACHED\\]\\s*', '', 'g')) AS rc, trim(regexp_replace(m, '\\[IMAGE ATTACHED\\]\\s*', '', 'g')) AS fx,
  list_concat(list_filter([coalesce(mcu_series, ''), coalesce(board, ''), coalesce(layer, ''), coalesce(component, ''), coalesce(issue_kind, ''), coalesce(severity, '')], lambda x: x <> '' AND lower(x) NOT IN ('unknown', 'other', 'n/a')),
    list_filter(list_transform(string_split(labels, ','), lambda x: trim(x)), lambda x: x <> ''), regexp_extract_all(m, '\\b([A-Z]{{2,}}[A-Z0-9_\\-]{{1,}}|[A-Za-z]+_[A-Za-z0-9_]+)\\b', 1)[:20]) AS words FROM d),
f AS (SELECT *, 'Problem: ' || {_ws("issue_title")} || chr(10) || 'Context: repo=' || repo || ', mcu_series=' || {_none("mcu_series")} || ', board=' || {_none("board")} || ', component=' || {_none("component")} || ', layer=' || layer || ', issue_kind=' || issue_kind || ', severity=' || {_none("severity")}
  || ', evidence_strength=' || evidence_strength || ', rescue_applied=' || CASE WHEN rescue_applied THEN 'True' ELSE 'False' END || ', state=open, issue_number=' || issue_number || chr(10) || 'Source URL: ' || coalesce(github_url, 'Not available')
  || chr(10) || 'Root cause: ' || coalesce(nullif({_first("rc", 260)}, ''), 'Not explicitly stated in issue thread.') || chr(10) || 'Fix: ' || coalesce(nullif({_first("fx", 320)}, ''), 'Inspect issue details and follow accepted workaround.')
  || chr(10) || 'Constraints: Validate against exact MCU/board configuration and CubeMX/CubeH7 version before applying.' || chr(10) || 'Keywords: ' || array_to_string(list_filter(words, lambda x, i: list_position(list_transform(words, lambda y: lower(y)), lower(x)) = i)[:12], ', ')
  || chr(10) || chr(10) || 'Technical details:' || chr(10) || m || CASE WHEN cm <> '' THEN chr(10) || chr(10) || 'Key comments:' || chr(10) || cm ELSE '' END AS whole FROM e),
g AS (SELECT *, trim(whole, ' ' || chr(10)) AS text FROM f), h AS (SELECT *, string_split(text, chr(10)) AS rows, trim(regexp_replace(lower(issue_title), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM g)
SELECT k, text, trim('# Card' || chr(10) || chr(10) || '## Metadata' || chr(10) || array_to_string(list_transform(rows[:12], lambda x: '- ' || x), chr(10)) || chr(10) || chr(10) || trim(array_to_string(rows[13:], chr(10)), ' ' || chr(10)), ' ' || chr(10)) || chr(10) AS markdown,
  'issue_' || issue_number || '_' || CASE WHEN issue_title = '' THEN 'issue' ELSE slug[:80] END || '.md' AS file FROM h
"""

FILES = {
    "k": K, "repo": "'RepoA'", "mcu_series": case(K, "'H7'", "null"), "file_type": case(K, "'driver_source'", "null", "'other'"), "path": case(K, f"'Src/a' || {K} || '.c'", "null", "'README.md'"), "board": "null", "component": case(K, "'ADC'", "null"), "category": "null",
    "example_name": case(K, "null", "'Blink'"), "images_count": case(K, "null", "2"), "content_extractor": case(K, "'pdf'", "null", "''"), "clean_text": case(K, f"'Driver of part {{0}}.  It is' || chr(10) || ' number ' || {K} || repeat(' and more', 12)", "null", "'no end'"),
}


def file_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "orders", FILES)
    named = issues.file_documents(rows.select("k", "repo", "path", "clean_text", "file_type"))
    return rows.select("k", issues.file_text(30, 60).alias("text")).join(named.select("k", F.col("id").alias("doc_id"), F.col("file_type").alias("kind"), "is_valid"), "k")


FILE_CARDS = f"""
WITH i AS ({made_sql("orders", FILES)}), c AS (SELECT *, {_ws("clean_text")} AS c FROM i), d AS (SELECT *, length(c) > 60 AS cut, CASE WHEN length(c) > 60 THEN rtrim(c[:60]) ELSE c END AS t FROM c)
SELECT k, trim('Document: ' || coalesce(path, 'unknown') || chr(10) || 'Context: repo=RepoA, mcu_series=' || {_none("mcu_series")} || ', file_type=' || {_none("file_type")} || ', path=' || {_none("path")} || ', board=None, component=' || {_none("component")} || ', category=None, example_name=' || {_none("example_name")}
  || chr(10) || 'Summary: ' || coalesce(nullif({_first("c", 30)}, ''), 'Technical reference document extracted from STM32Cube repository.') || chr(10) || 'Visual assets: ' || coalesce(images_count, 0) || chr(10) || 'Content extractor: ' || coalesce(nullif(content_extractor, ''), 'text')
  || chr(10) || 'Constraints: Validate against exact STM32 series/board and firmware package before applying.' || chr(10) || chr(10) || 'Technical details:' || chr(10) || t || CASE WHEN cut THEN ' [technical_details_truncated original_chars=' || length(c) || ' kept_chars=' || length(t) || ']' ELSE '' END, ' ' || chr(10)) AS text,
  'repoa-file-' || sha1('repoa:' || coalesce(path, ''))[:16] AS doc_id, coalesce(file_type, 'other') AS kind, length(coalesce(clean_text, '')) >= 100 AS is_valid FROM d
"""

# ---- diagnostic cards

_TEXT = f"""'Problem: p' || {K} || chr(10) || 'Context: repo=a, board=b. More' || chr(10) || 'Root cause: ' || {case(K, "'The DMA callback is never reached. Second'", "'Thanks for all'", "''", "'Wrong cache setup'", "'Regression of the package'")} || chr(10) || 'Fix: '
  || {case(K, "'Build it again with HAL 1.2'", "''", "'Hello @you'", "'Use the clock!'")} || chr(10) || 'Constraints: Check the board. Always' || chr(10) || 'Keywords: dma, HAL_SPI_Init,  spi ' || chr(10) || chr(10) || 'Technical details:' || chr(10) || {_BODY}"""
DIAGNOSTIC = {
    "k": K, "has_issue": f"{K} % 5 <> 0", "has_case": f"{K} % 4 <> 1", "component": case(K, "'SPI'", "'ADC'", "''", "null"), "board": case(K, "'NUCLEO-H743ZI'", "null", "null"), "layer": case(K, "'HAL'", "'Other'", "null"), "issue_kind": case(K, "'bug_report'", "'other'"),
    "severity": case(K, "'high'", "'low'"), "mcu_series": case(K, "'H7'", "null", "'stm32f4'", "''"), "evidence_strength": case(K, "'high'", "null", "'low'"), "rescue_applied": f"{K} % 2 = 0", "labels": case(K, "'bug,spi'", "''"),
    "github_url": case(K, f"'https://x/i/' || {K}", "null", f"'https://x/i/' || {K}"), "title": case(K, "'SPI DMA transfer blocks in callback'", "'Compile error after upgrade to stm32cubef4 v1.2.0'", "'HardFault on timer interrupt of TIM'", "'Thanks for the support'", "'Clock timeout. Second sentence'", "''"),
    "card": _TEXT, "status": case(K, "'merged_fix'", "'candidate_fix'", "'commit_only_candidate'", "'reference_only'", "null"), "confidence": case(K, "'high'", "'medium'", "'low'", "null"), "shas": case(K, "'a1,b2'", "''", "'c3'"), "pr_urls": case(K, "'u1,u2,u3,u4'", "''", "'u5'"),
    "commit_urls": case(K, "'v1,v2,v3'", "''"), "paths": case(K, "'Src/a.c,Src/b.c'", "''"), "modules": case(K, "'HAL_Driver'", "'Projects,Drivers'", "''"), "components": case(K, "'SPI,DMA'", "''"), "merged_files": f"{K} % 3 = 0",
    "solved": f"'Problem: Issue #' || {K} || chr(10) || 'Context: repo=a. Rest' || chr(10) || 'Resolver signal: score=1' || chr(10) || 'Assessment: ' || {case(K, "'Fix likely integrated. Use it'", "'thanks to all'")} || chr(10) || 'Candidate PRs: ' || {case(K, "'Fix dma'", "''")}",
}
_SHOWN = ("query_aliases", "confirmed_facts", "plausible_diagnosis", "debug_checks", "clarification_questions", "likely_causes", "possible_workarounds", "constraints_or_limits", "hypotheses", "keywords", "source_types", "target_series", "api_family_tags", "technical_pattern_tags", "version_tags")


def diagnostic_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, "orders", DIAGNOSTIC, f"{K} % 5 <> 0 OR {K} % 4 <> 1")
    issue = F.struct(F.lit("RepoF4").alias("repo"), F.col("k").alias("issue_number"), F.col("title").alias("issue_title"), "github_url", F.col("card").alias("st_ready_text"), "component", "board", "layer", "issue_kind", "severity", "mcu_series", "evidence_strength", "rescue_applied", listed("labels").alias("labels"))
    solved = F.struct(F.col("k").alias("issue_number"), F.lit("From the case").alias("issue_title"), F.lit("https://x/case").alias("issue_url"), F.col("solved").alias("resolver_card_text"), F.col("status").alias("resolution_status"), F.col("confidence").alias("link_confidence"), listed("shas").alias("linked_commit_shas"),
                      listed("pr_urls").alias("linked_pr_urls"), listed("commit_urls").alias("linked_commit_urls"), listed("paths").alias("linked_file_paths"), listed("modules").alias("impacted_modules"), listed("components").alias("impacted_components"), F.col("merged_files").alias("merged_pr_with_file_evidence"))
    left = rows.where("has_issue").select("k", issue.alias("issue"))
    right = rows.where("has_case").select("k", solved.alias("case"))
    cards = diagnostic.cards(left.join(right, "k", "full_outer").select(F.lit("RepoF4").alias("repo"), "issue", "case"))
    refs = F.array_join(F.transform("evidence_refs", lambda r: F.concat_ws("/", r["type"], r["url"], r["confidence"])), "|")
    return cards.select(F.col("issue_number").alias("k"), "id", "title", "symptom_summary", "affected_context", *(bar(c).alias(c) for c in _SHOWN), refs.alias("refs"), F.col("evidence_strength").alias("strength"), F.md5("st_ready_text").alias("text_md5"))


def _some(condition: str, *items: str) -> str:
    return f"CASE WHEN {condition} THEN [" + ", ".join(items) + "] ELSE []::VARCHAR[] END"


def _signal(c: str, most: int) -> str:
    s = _first(_ws(c), most)
    return f"(CASE WHEN regexp_matches(lower({s}), '^(hi @|hello @|thank you|thanks|best regards|with regards|st internal reference)') THEN '' ELSE {s} END)"


def _line(text: str, key: str) -> str:
    """The value of a line of a text that has the key once, with no spaces around."""
    return f"trim(regexp_extract({text}, '(?m)^{key}:(.*)$', 1))"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PATTERNS = (("callback", "callback_not_reached"), ("busy", "state_stuck_busy"), ("timeout|timed out", "timeout"), ("block", "blocking_behavior"), ("dma", "dma_path"), ("compile|build", "compile_error"), ("crash|hardfault|fault", "crash_fault"),
             ("regression|upgrade|version", "version_regression"), ("clock", "clocking"), ("pin|gpio|mux", "pinmux"), ("irq|interrupt", "interrupt_path"), ("cache|mpu", "cache_dma"))


def _tag(*names: str) -> str:
    return "(" + " OR ".join(f"list_contains(pat, '{n}')" for n in names) + ")"


def _versions(c: str, pattern: str) -> str:
    return f"list_transform(list_zip(regexp_extract_all({c}, '{pattern}', 1), regexp_extract_all({c}, '{pattern}', 2)), lambda z: upper(z[1]) || ' v' || z[2])"


_NV = r"(?i)\b(stm32cube[a-z0-9_-]*)\s*v(?:ersion)?\s*(\d+\.\d+\.\d+)\b", r"(?i)\b(cubemx|cubeide)\s*v?(\d+\.\d+(?:\.\d+)?)\b", r"(?i)\b(hal|ll|cmsis)\s*v?(\d+\.\d+(?:\.\d+)?)\b"
_API = r"\b(?:HAL|LL|BSP|MX|CMSIS)_[A-Za-z0-9_]+\b"
_NAMED = "icomp <> ''"
DIAGNOSTIC_CARDS = f"""
WITH i AS ({made_sql("orders", DIAGNOSTIC, f"{K} % 5 <> 0 OR {K} % 4 <> 1")}),
a AS (SELECT k, has_issue AS hi, has_case AS hc, CASE WHEN has_issue THEN card ELSE '' END AS it, CASE WHEN has_case THEN solved ELSE '' END AS rt, CASE WHEN has_issue THEN coalesce(component, '') ELSE '' END AS icomp, CASE WHEN has_issue THEN coalesce(board, '') ELSE '' END AS ibrd,
  CASE WHEN has_issue THEN coalesce(mcu_series, '') ELSE '' END AS iser, CASE WHEN has_issue THEN coalesce(layer, '') ELSE '' END AS ilay, CASE WHEN has_issue THEN issue_kind ELSE '' END AS ikind, CASE WHEN has_issue THEN severity ELSE '' END AS isev, CASE WHEN has_issue THEN github_url END AS iurl,
  CASE WHEN has_issue THEN evidence_strength END AS istr, has_issue AND rescue_applied AS resc, CASE WHEN has_issue THEN list_filter(string_split(labels, ','), lambda x: x <> '') ELSE []::VARCHAR[] END AS ilab, CASE WHEN has_case THEN status END AS st, CASE WHEN has_case THEN confidence END AS cf,
  {", ".join(f"CASE WHEN has_case THEN list_filter(string_split({c}, ','), lambda x: x <> '') ELSE []::VARCHAR[] END AS {c}" for c in ("shas", "pr_urls", "commit_urls", "paths", "modules", "components"))}, has_case AND merged_files AS mf,
  coalesce(CASE WHEN has_issue THEN nullif(title, '') END, CASE WHEN has_case THEN 'From the case' END, 'p' || k) AS title FROM i),
b AS (SELECT *, {_line("it", "Context")} AS ictx, {_line("it", "Root cause")} AS iroot, {_line("it", "Fix")} AS ifix, {_line("it", "Constraints")} AS icon, {_line("it", "Keywords")} AS ikey, {_line("rt", "Context")} AS rctx, {_line("rt", "Resolver signal")} AS rsig, {_line("rt", "Assessment")} AS rass,
  {_line("rt", "Candidate PRs")} AS rcand, CASE WHEN it = '' THEN '' ELSE trim(string_split(it, 'Technical details:' || chr(10))[2]) END AS body FROM a),
c AS (SELECT *, regexp_extract_all(it || ' ' || rt, '{_API}') AS api0, lower(title || ' ' || iroot || ' ' || ifix || ' ' || body || ' ' || it || ' ' || rt) AS allp, title || ' ' || body || ' ' || ictx || ' ' || ifix || ' ' || it || ' ' || rt AS allv FROM b),
d AS (SELECT *, list_filter(api0, lambda x, j: list_position(list_transform(api0, lambda y: lower(y)), lower(x)) = j)[:8] AS api, list_filter([{", ".join(f"CASE WHEN regexp_matches(allp, '{p}') THEN '{t}' END" for p, t in _PATTERNS)}], lambda x: x IS NOT NULL)[:8] AS pat,
  list_concat({", ".join(_versions("allv", p) for p in _NV)}) AS ver0, lower(body) AS low FROM c),
e AS (SELECT *, list_filter(ver0, lambda x, j: list_position(ver0, x) = j)[:8] AS ver, len(list_filter(api, lambda x: starts_with(x, 'HAL_SPI'))) > 0 AND {_tag("dma_path")} AS spi, {_tag("state_stuck_busy", "callback_not_reached")} AS stuck FROM d),
f AS (SELECT *, list_concat({_some(_NAMED, "icomp || ' issue'")}, {_some(_NAMED + " AND " + _tag("compile_error"), "icomp || ' compile error'")}, {_some(_NAMED + " AND " + _tag("timeout"), "icomp || ' timeout'")}, {_some(_NAMED + " AND " + _tag("dma_path"), "icomp || ' DMA issue'")},
  {_some(_NAMED + " AND ibrd <> ''", "ibrd || ' ' || icomp")}, flatten(list_transform(api[:4], lambda x: [x, x || ' issue'])), list_transform(ver[:3], lambda x: 'version regression ' || x), [{_first(_ws("title"), 120)}]) AS plain FROM e),
g AS (SELECT *, list_concat({_some("spi", "'HAL_SPI_Transmit_DMA'", "'SPI DMA transfer'")}, {_some("spi AND stuck", *map(_q, ("HAL_SPI_Transmit_DMA blocking function", "small amount of data", "small transfer", "2 bytes", "2 bytes example")))},
  {_some("stuck AND (" + _tag("dma_path") + " OR spi)", *map(_q, ("blocking function", "seems blocking", "blocking behavior", "callback not reached", "state stuck busy")))}, {_some("regexp_matches(low, '\\bsmall\\b') AND regexp_matches(low, '\\btransfer\\b')", "'small transfer'")},
  list_transform(regexp_extract_all(low, '\\b(\\d{{1,4}})\\s*bytes?\\b', 1)[:3], lambda x: x || ' bytes'), {_few("plain", 12)}, CASE WHEN {_tag("version_regression")} THEN list_transform(ver[:2], lambda x: 'upgrade issue ' || x) ELSE []::VARCHAR[] END) AS al0 FROM f),
h AS (SELECT *, {_few("al0", 16)} AS al FROM g),
j AS (SELECT *, coalesce(nullif({_signal("ifix", 220)}, ''), nullif({_signal("title", 220)}, ''), title) AS sym0,
  list_concat({_some("iurl IS NOT NULL", "'Issue evidence exists in RepoF4 issue #' || k")}, {_some("resc", _q("The issue was rescued by the preprocessing filter because technical signals were detected"))}, {_some("coalesce(istr, '') <> ''", "'Issue evidence strength is rated ' || istr")},
    {_some("st IS NOT NULL", "'Resolver linkage status is ' || st || ' with confidence ' || coalesce(cf, 'unknown')")}, {_some("len(shas) > 0", _q("A linked commit or pull request exists for this issue path"))}, {_some("mf", _q("A merged PR with changed-file evidence exists even if commit history is merge-heavy"))}, [{_signal("iroot", 180)}]) AS facts0,
  list_concat({_some("ilay || icomp || ikind <> ''", "'Observed behavior aligns with ' || array_to_string(list_filter([ilay, icomp, ikind], lambda x: x <> ''), ', ') || ' issue characteristics'")}, {_some("st = 'merged_fix'", _q("A mainline fix likely exists, so local package drift is a plausible cause"))},
    {_some("st = 'candidate_fix'", _q("A candidate fix exists, suggesting the problem may already be understood upstream"))}, {_some("st = 'commit_only_candidate'", _q("Commit-level evidence suggests an upstream fix candidate, but PR traceability is incomplete"))},
    {_some(_tag("version_regression"), _q("Behavior may depend on the exact Cube or HAL version in use"))}, {_some(_tag("blocking_behavior", "state_stuck_busy"), _q("The application may be observing a completion-path or state-machine defect rather than a true hard block"))}) AS diag0,
  list_concat({_some(_tag("callback_not_reached", "state_stuck_busy"), _q("Instrument callback entry points and verify state transitions around the failing call"), _q("Check whether the peripheral state returns to READY after the operation"))},
    {_some(_tag("compile_error"), _q("Rebuild with the exact toolchain and package version referenced in the report"))}, {_some(_tag("timeout"), _q("Capture timeout path timing and compare it with clock and interrupt configuration"))},
    {_some("len(paths) > 0", "'Review the linked fix path and compare your local source against ' || paths[1]")}, {_some(_NAMED, "'Validate the exact ' || icomp || ' configuration on the target board and firmware package'")}, [{_q("Reproduce on a minimal project using the same board, Cube package, and middleware settings")}]) AS checks0,
  list_concat([{_q("Which exact MCU part number and board are you using?")}], {_some("iser <> ''", "'Can you confirm whether your target is ' || iser || ' and not a close variant?'")}, {_some("len(ver) > 0", _q("Which exact Cube/CubeMX/CubeIDE package versions are installed in your project?"))},
    {_some(_NAMED, "'Can you share the ' || icomp || ' configuration and initialization sequence?'")}, {_some(_tag("dma_path", "cache_dma"), _q("Are DMA buffers cache-coherent and are clean/invalidate operations applied correctly?"))},
    {_some(_tag("interrupt_path", "callback_not_reached"), _q("Do interrupts/callbacks trigger as expected with the current NVIC priorities?"))}, {_some("len(api) > 0", "'Can you provide a minimal reproducer around ' || api[1] || ' with expected vs observed behavior?'")}) AS ask0,
  [{_signal("iroot", 220)}, {_signal("rass", 220)}, {_signal("rsig", 220)}] AS cause0,
  list_concat([{_signal("ifix", 220)}], {_some("rcand <> ''", _q("Test the candidate fix path or PR on an isolated branch before merging locally"))}, {_some(_tag("dma_path"), _q("Try an alternate transfer mode on a minimal case to isolate DMA-specific behavior"))}, [{_q("Pin a known-good firmware package version while validating the issue scope")}]) AS work0,
  list_concat([{_first(_ws("icon"), 220)}], {_some("resc", _q("This card is derived from a rescued issue and still requires board-level validation"))}, {_some("cf IN ('low', 'medium')", _q("Linked fix evidence is not strong enough to assume universal applicability"))}, [{_q("Validate against the exact MCU series, board, package version, and local integration path")}]) AS lim0,
  list_concat(CASE WHEN hi THEN string_split(ikey, ',') ELSE []::VARCHAR[] END, ilab, list_filter([icomp, ilay, ikind, isev, ibrd], lambda x: lower(x) NOT IN ('none', 'unknown', 'other', 'n/a')), modules, components, [coalesce(st, '')], pat, ver, api) AS key0 FROM h),
l AS (SELECT *, {_few("facts0", 4)} AS facts, CASE WHEN len({_few("diag0", 12)}) > 0 THEN {_few("diag0", 12)} ELSE [{_q("The issue requires targeted reproduction to distinguish configuration error from upstream defect")}] END AS diag, {_few("checks0", 5)} AS checks, {_few("ask0", 6)} AS ask,
  CASE WHEN len({_few("cause0", 12)}) > 0 THEN {_few("cause0", 12)} ELSE [{_q("Root cause is not explicit; use the issue thread and linked changes for triage")}] END AS cause, {_few("work0", 4)} AS work, {_few("lim0", 4)} AS lim, {_few("key0", 14)} AS key1,
  list_concat(CASE WHEN iurl IS NOT NULL THEN [{{'t': 'issue', 'u': iurl, 'c': istr}}] ELSE [] END, list_transform(pr_urls, lambda x: {{'t': 'pull_request', 'u': x, 'c': cf}}), list_transform(commit_urls, lambda x: {{'t': 'commit', 'u': x, 'c': cf}}))[:6] AS refs,
  list_concat({_some("resc", "'rescued_issue'")}, {_some("hc", "'resolver_case'")}) AS src0, CASE WHEN iser = '' THEN 'STM32F4' WHEN iser = 'H7' THEN 'STM32H7' ELSE upper(iser) END AS ser FROM j),
m AS (SELECT *, {_few("list_concat(diag, cause)", 8)} AS hyp, {_few("list_concat(al, key1)", 24)} AS keys, CASE WHEN len(src0) = 0 THEN ['issue'] ELSE src0 END AS src,
  CASE WHEN len(al) > 0 AND len(list_filter(al[:2], lambda x: contains(lower(sym0), lower(x)))) = 0 THEN sym0 || ' (' || array_to_string(al[:2], ', ') || ').' ELSE sym0 END AS sym FROM l)
SELECT k, 'diag::RepoF4::issue::' || k AS id, title, sym AS symptom_summary, {_first(_ws("CASE WHEN ictx <> '' THEN ictx ELSE rctx END"), 220)} AS affected_context, array_to_string(al, '|') AS query_aliases, array_to_string(facts, '|') AS confirmed_facts, array_to_string(diag, '|') AS plausible_diagnosis,
  array_to_string(checks, '|') AS debug_checks, array_to_string(ask, '|') AS clarification_questions, array_to_string(cause, '|') AS likely_causes, array_to_string(work, '|') AS possible_workarounds, array_to_string(lim, '|') AS constraints_or_limits, array_to_string(hyp, '|') AS hypotheses, array_to_string(keys, '|') AS keywords,
  array_to_string(src, '|') AS source_types, ser AS target_series, array_to_string(api, '|') AS api_family_tags, array_to_string(pat, '|') AS technical_pattern_tags, array_to_string(ver, '|') AS version_tags,
  array_to_string(list_transform(refs, lambda r: r.t || '/' || r.u || coalesce('/' || r.c, '')), '|') AS refs, coalesce(istr, cf) AS strength,
  md5('Problem: ' || title || chr(10) || 'Context: repo=RepoF4, issue_number=' || k || ', target_series=' || ser || ', source_types=' || array_to_string(src, ', ') || chr(10) || 'Symptoms: ' || sym || chr(10) || 'Query aliases: ' || array_to_string(al, ' | ') || chr(10)
    || 'Response format: facts_confirmed -> hypotheses -> checks' || chr(10) || 'Facts confirmed: ' || array_to_string(facts, ' | ') || chr(10) || 'Hypotheses: ' || array_to_string(hyp, ' | ') || chr(10) || 'Checks: ' || array_to_string(checks, ' | ') || chr(10)
    || 'Clarification questions (required): ' || array_to_string(ask, ' | ') || chr(10) || 'Likely causes: ' || array_to_string(cause, ' | ') || chr(10) || 'Confirmed facts: ' || array_to_string(facts, ' | ') || chr(10) || 'Plausible diagnosis: ' || array_to_string(diag, ' | ') || chr(10)
    || 'Debug actions: ' || array_to_string(checks, ' | ') || chr(10) || 'Workaround: ' || array_to_string(work, ' | ') || chr(10) || 'Constraints: ' || array_to_string(lim, ' | ') || chr(10) || 'Evidence links: ' || array_to_string(list_transform(refs, lambda r: r.u), ' | ') || chr(10) || 'Keywords: ' || array_to_string(keys, ' ')) AS text_md5 FROM m
"""

QUERIES = {"file_inclusion": file_inclusion, "issue_rules": issue_rules, "issue_cards": issue_cards, "file_cards": file_cards, "diagnostic_cards": diagnostic_cards}
ORACLE_SQL = {"file_inclusion": FILE_INCLUSION, "issue_rules": ISSUE_RULES, "issue_cards": ISSUE_CARDS, "file_cards": FILE_CARDS, "diagnostic_cards": DIAGNOSTIC_CARDS}
