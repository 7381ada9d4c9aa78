"""Component and tag queries on texts made from order keys, which hold the domain's words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.operators import tagging
from loomwright.session import table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    names = F.array(*map(F.lit, tagging.COMPONENTS))
    pick = lambda m: F.element_at(names, (F.pmod(k * m, F.lit(len(tagging.COMPONENTS))) + 1).cast("int"))
    text = F.concat(
        F.lit("HAL_"), pick(1), F.lit("_Init stuck busy with "), pick(7), F.lit(" timeout on stm32cubef"), F.pmod(k, F.lit(8)), F.lit(" v1."), F.pmod(k, F.lit(9)), F.lit(".0; LL_"), pick(3),
        F.lit("_Enable and HAL 1.2\nKeywords: "), F.lower(pick(1)), F.lit(", "), pick(11), F.when(F.pmod(k, F.lit(5)) == 0, F.concat(F.lit("\nContext: component="), F.lower(pick(2)), F.lit(", x"))).otherwise(""),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"), F.array(pick(7)).alias("labels"), F.concat(F.lit("Drivers/"), pick(1), F.when(F.pmod(k, F.lit(2)) == 0, "_HAL_Driver/x.c").otherwise("/CMSIS/x.c")).alias("path"))


def component_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("o_orderkey", tagging.infer_component(F.col("text")).alias("c")).select("o_orderkey", "c.*")


def component_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("o_orderkey", tagging.vote_component(F.col("text"), F.col("labels")).alias("component"), tagging.module_of(F.col("path")).alias("module"))


def text_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _texts(spark, sf_dir).select("o_orderkey", F.array_join(tagging.api_tags(t), ",").alias("apis"), F.array_join(tagging.failure_tags(t), ",").alias("failures"), F.array_join(tagging.version_tags(t), ",").alias("versions"), tagging.query_type(t).alias("query_type"))


def answer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    mode = F.when(F.pmod(k, F.lit(2)) == 0, "all").otherwise("any")
    expected = F.when(F.pmod(k, F.lit(7)) == 0, "").otherwise("hal_[a-m]|timeout| LL_[a-f] ")
    return _texts(spark, sf_dir).select("o_orderkey", tagging.expected_match(F.col("text"), expected, mode).alias("ok"), tagging.question_id(F.concat(F.lit("item "), k)).alias("question_id"))


_N = len(tagging.COMPONENTS)
_LIST = str(list(tagging.COMPONENTS))
_TEXT = f"""
WITH n AS (SELECT o_orderkey AS k, {_LIST} AS c FROM orders),
t AS (SELECT k AS o_orderkey, c[k * 7 % {_N} + 1] AS label, 'Drivers/' || c[k % {_N} + 1] || CASE WHEN k % 2 = 0 THEN '_HAL_Driver/x.c' ELSE '/CMSIS/x.c' END AS path,
  'HAL_' || c[k % {_N} + 1] || '_Init stuck busy with ' || c[k * 7 % {_N} + 1] || ' timeout on stm32cubef' || k % 8 || ' v1.' || k % 9 || '.0; LL_' || c[k * 3 % {_N} + 1] || '_Enable and HAL 1.2' || chr(10) || 'Keywords: ' || lower(c[k % {_N} + 1]) || ', ' || c[k * 11 % {_N} + 1]
  || CASE WHEN k % 5 = 0 THEN chr(10) || 'Context: component=' || lower(c[k * 2 % {_N} + 1]) || ', x' ELSE '' END AS text FROM n)
"""
_CASES = " ".join(f"WHEN x = '{a}' THEN '{b}'" for a, b in tagging.ALIASES.items())
_NORM = "list_filter(list_transform(list_transform({}, lambda x: regexp_replace(regexp_replace(upper(trim(x)), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), lambda x: CASE " + _CASES + " ELSE x END), lambda x: x IN " + str(tuple(tagging.COMPONENTS)) + ")"

QUERIES = {"component_inference": component_inference, "component_votes": component_votes, "text_tags": text_tags, "answer_checks": answer_checks}

ORACLE_SQL = {
    "component_inference": _TEXT + f"""
, x AS (SELECT o_orderkey, text, unnest({_LIST}) AS c FROM t), y AS (SELECT o_orderkey, c, len(regexp_extract_all(text, '(?i)(?:\\\\b|_)' || c || '(?:\\\\b|_)')) AS a, len(regexp_extract_all(text, '(?i)' || c || '[_A-Z0-9]+')) AS b,
  len(regexp_extract_all(text, '(?i)HAL_' || c || '[_A-Z0-9]*')) + len(regexp_extract_all(text, '(?i)LL_' || c || '[_A-Z0-9]*')) AS h FROM x),
s AS (SELECT o_orderkey, c, CAST(a + 2 * b + 3 * h AS INT) AS score, CAST(a + b + h AS INT) AS hits, row_number() OVER (PARTITION BY o_orderkey ORDER BY a + 2 * b + 3 * h DESC, a + b + h DESC, c) AS r FROM y WHERE a + b + h > 0),
g AS (SELECT o_orderkey, string_agg(c || '(score=' || score || ',hits=' || hits || ')', ', ' ORDER BY r) FILTER (r <= 3) AS candidates FROM s GROUP BY 1)
SELECT s.o_orderkey, c AS component, score, hits, CASE WHEN (c NOT IN ('CAN', 'COMP', 'TIM') AND score >= 8 AND hits >= 2) OR (c IN ('CAN', 'COMP', 'TIM') AND score >= 20 AND hits >= 6) THEN 'high' WHEN (c NOT IN ('CAN', 'COMP', 'TIM') AND score >= 4) OR (c IN ('CAN', 'COMP', 'TIM') AND score >= 10) THEN 'medium' ELSE 'low' END AS confidence, candidates
FROM s JOIN g ON s.o_orderkey = g.o_orderkey WHERE r = 1""",
    "component_votes": _TEXT + rf"""
, v AS (SELECT o_orderkey, path, {_NORM.format("[regexp_extract(text, '(?i)\\bcomponent=([^,\\n]+)', 1)]".replace(chr(92) * 2, chr(92)))}[1] AS ctx, {_NORM.format("string_split(regexp_extract(text, '(?im)^Keywords:\\s*(.+)$', 1), ',')".replace(chr(92) * 2, chr(92)))} AS kw, {_NORM.format('[label]')} AS lb,
  {_NORM.format("regexp_extract_all(text, '\\b[A-Z][A-Z0-9_\\-/]{1,}\\b')".replace(chr(92) * 2, chr(92)))} AS cap FROM t),
u AS (SELECT o_orderkey, unnest(kw) AS c, 3 AS w FROM v UNION ALL SELECT o_orderkey, unnest(lb), 2 FROM v UNION ALL SELECT o_orderkey, unnest(cap), 1 FROM v), s AS (SELECT o_orderkey, c, sum(w) AS v FROM u GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC, c) AS n, count(*) OVER (PARTITION BY o_orderkey, v) AS ties FROM s)
SELECT v.o_orderkey, coalesce(ctx, CASE WHEN r.v >= CASE WHEN r.c IN ('CAN', 'COMP', 'TIM') THEN 3 ELSE 2 END AND ties = 1 THEN r.c END) AS component,
  CASE WHEN contains(lower(path), 'hal_driver') THEN 'HAL_Driver' WHEN contains(lower(path), 'cmsis') THEN 'CMSIS' ELSE 'Drivers' END AS module FROM v LEFT JOIN r ON v.o_orderkey = r.o_orderkey AND n = 1""",
    "text_tags": _TEXT + f"""SELECT o_orderkey, array_to_string(regexp_extract_all(text, '\\b(?:HAL|LL|BSP|MX|CMSIS)_[A-Za-z0-9_]+\\b'), ',') AS apis,
      array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{tag}' END" for p, tag in tagging.FAILURES)}], lambda x: x IS NOT NULL)[1:8], ',') AS failures,
      'STM32CUBEF' || o_orderkey % 8 || ' v1.' || o_orderkey % 9 || '.0,HAL v1.2' AS versions, 'error_message' AS query_type FROM t""".replace(chr(92) * 2, chr(92)),
    "answer_checks": _TEXT + """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN CASE WHEN regexp_matches(text, '(?i)hal_[a-m]') AND regexp_matches(text, '(?i)timeout') AND regexp_matches(text, '(?i)LL_[a-f]') THEN '1' ELSE '0' END ELSE '1' END AS ok,
      'Q' || lpad(CAST(o_orderkey AS VARCHAR), greatest(2, length(CAST(o_orderkey AS VARCHAR)))::INT, '0') AS question_id FROM t""",
}
