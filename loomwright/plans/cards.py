"""Card, aggregate and gate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.rules import score_band, text_of
from loomwright.operators import cards, passages, quality, regions
from loomwright.session import table

#: Bounds of the score bands, and the question templates.
BANDS = ((95.0, "excellent"), (85.0, "good"), (70.0, "acceptable"))
TEMPLATES = ("What is new in {name}?", "How do I configure a clock in {name}?", "Which issues of {name} are fixed?", "Where is the documentation of {name}?")


def _doc_stats(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.count_if(F.length(text_of("text")) >= 100).alias("long"))


def strategy_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = table(spark, sf_dir, "events").select("event_type", *((F.pmod(k, F.lit(d)) == 0).cast("int").alias(n) for n, d in (("f1", 2), ("f3", 3), ("fa", 5), ("fh", 7))), F.round("value", 2).alias("latency"))
    out = quality.strategy_scores(rows, "event_type", "f1", "f3", "fa", "fh", "latency")
    return out.select("event_type", *(F.round(c, 6).alias(c) for c in ("top1", "top3", "answer", "hallucination", "latency_norm", "score")))


def ab_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts and open shares of two halves, for each priority and for all."""
    half = F.pmod("o_orderkey", F.lit(2))
    rows = table(spark, sf_dir, "orders").withColumn("half", half)
    scopes = quality.scoped(rows, "o_orderpriority", {"a": F.count_if(F.col("half") == 0), "b": F.count_if(F.col("half") == 1), "open_a": F.count_if((F.col("half") == 0) & (F.col("o_orderstatus") == "O")), "open_b": F.count_if((F.col("half") == 1) & (F.col("o_orderstatus") == "O"))})
    return scopes.select("scope", "a", "b", F.round(F.col("open_b") / F.col("b") - F.col("open_a") / F.col("a"), 6).alias("delta"))


def offline_online_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of customers (offline) and of their orders (online) on the customer's key."""
    off = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.floor("c_acctbal").alias("offline"))
    on = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.floor(F.max("o_totalprice")).alias("online"))
    return off.join(on, "id", "left").select("id", "offline", "online", (F.col("online") - F.col("offline")).alias("delta"))


def coverage_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    out = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.count("quality").alias("labelled"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count("text").alias("with_text"))
    return out.select("lang", "docs", *(quality.percent(F.col(c), F.col("docs")).alias(f"{c}_pct") for c in ("labelled", "toxic", "with_text")))


def score_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _doc_stats(table(spark, sf_dir, "documents")).withColumn("pct", quality.percent(F.col("long"), F.col("docs")))
    return stats.withColumn("band", score_band(F.col("pct"), BANDS, "low"))


def full_outer_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and documents that hold a whole benchmark passage, on the document."""
    hit = passages.holding(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", F.lit(1).alias("leak"))
    return cards.merged(table(spark, sf_dir, "labels"), hit, "doc_id").select("doc_id", "quality", "leak")


def anti_join_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]).groupBy("source").agg(F.count(F.lit(1)).alias("unlabelled"))


def duplicate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated(table(spark, sf_dir, "documents").select(F.md5(text_of("text")).alias("h")), ["h"])


def schema_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.violations(table(spark, sf_dir, "documents"), "documents", {"doc_id_required": F.col("doc_id").isNotNull(), "lang_enum": F.col("lang").isin("en", "fr", "de"), "n_chars_minimum": F.col("n_chars") >= 100, "n_chars_is_length": F.col("n_chars") == F.length("text")})
    events = quality.violations(table(spark, sf_dir, "events"), "events", {"value_minimum": F.col("value") >= 0, "type_enum": F.col("event_type").isin("click", "view"), "props_json": F.try_parse_json("props").isNotNull()})
    return docs.unionByName(events)


def placeholder_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", F.regexp_count("html", F.lit(r"\[IMAGE ATTACHED\]|&copy;|TODO")).alias("n"))
    return found.where("n > 0")


def cross_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = spark.createDataFrame(list(enumerate(TEMPLATES)), "template int, question string")
    return cards.from_templates(made, table(spark, sf_dir, "region").select("r_name"), "question", {"name": "r_name"}).select("template", "r_name", "question")


def card_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card for each order with its customer and the customer's nation."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    full = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    text = cards.lines(("ISSUE", F.col("o_orderkey")), ("STATE", F.col("o_orderstatus")), ("OPEN", cards.flag_text(F.col("o_orderstatus") == "O")), ("AUTHOR", cards.none_text(F.col("c_name"))), ("SEGMENT", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))), ("NATION", F.col("n_name")))
    return full.select("o_orderkey", text.alias("card"))


def markdown_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", cards.bullets(F.regexp_replace(text_of("text"), "[\t\r]", " "), 3).alias("card"))


def evidence_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to six references of each order: itself, its suppliers, its parts."""
    line = table(spark, sf_dir, "lineitem")
    sets = line.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias("s"), F.sort_array(F.collect_set("l_partkey")).alias("p"))
    refs = cards.evidence_refs([("issue", F.array("l_orderkey")), ("pr", F.slice("s", 1, 2)), ("commit", F.col("p"))])
    return sets.select("l_orderkey", F.array_join(F.transform(refs, lambda r: F.concat_ws(":", r["type"], r["id"])), " ").alias("refs"))


def component_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.count_distinct("p_type").alias("types"), F.min("p_partkey").alias("first"), F.max("p_size").alias("largest"))


def tag_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market segments to nation ids by name, unresolved ones listed: a dimension join."""
    tags = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey"))).alias("tag")).distinct()
    dim = table(spark, sf_dir, "nation").select(F.upper("n_name").alias("tag"), F.col("n_nationkey").alias("tag_id"))
    return tags.join(dim, F.upper(tags["tag"]) == dim["tag"], "left").select(tags["tag"], "tag_id", F.col("tag_id").isNull().alias("unresolved"))


def union_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("status"))
    b = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("segment"))
    return a.unionByName(b)


def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global score: stage scores weighted by stage."""
    s = table(spark, sf_dir, "part").groupBy("p_size").agg(F.count(F.lit(1)).alias("w"), F.floor(F.max("p_retailprice")).alias("s"))
    return s.agg(F.round(F.sum(F.col("w") * F.col("s")) / F.sum("w"), 6).alias("score"))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.pmod(F.col("l_partkey") * 7, F.lit(900)).alias("x"), F.pmod(F.col("l_suppkey") * 13, F.lit(900)).alias("y"), (F.col("l_quantity") * 4 + 20).cast("long").alias("w"), (F.col("l_linenumber") * 20 + 20).cast("long").alias("h")).distinct()


def bbox_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping rectangles of an order."""
    b = _boxes(spark, sf_dir)
    box = F.struct("x", "y", "w", "h")
    a, c = b.select("l_orderkey", box.alias("a")), b.select("l_orderkey", box.alias("b"))
    both = a.join(c, "l_orderkey").where(F.col("a") < F.col("b")).withColumn("area", regions.intersection(F.col("a"), F.col("b"))).where("area > 0")
    return both.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("pairs"), F.sum("area").alias("area"))


def region_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles of an order that lie close, merged to their hulls until none are close."""
    return regions.merge_close(_boxes(spark, sf_dir), "l_orderkey")


QUERIES = {
    "strategy_score": strategy_score, "ab_delta": ab_delta, "offline_online_delta": offline_online_delta, "coverage_pct": coverage_pct, "score_labels": score_labels, "full_outer_cards": full_outer_cards, "anti_join_gate": anti_join_gate,
    "duplicate_gate": duplicate_gate, "schema_validator": schema_validator, "placeholder_gate": placeholder_gate, "cross_template": cross_template, "card_text": card_text, "markdown_card": markdown_card,
    "evidence_cards": evidence_cards, "component_split": component_split, "tag_mapping": tag_mapping, "union_summary": union_summary, "weighted_score": weighted_score, "bbox_overlap": bbox_overlap,
    "region_merge": region_merge,
}

_BOX = "SELECT DISTINCT l_orderkey, (l_partkey * 7) % 900 AS x, (l_suppkey * 13) % 900 AS y, CAST(l_quantity * 4 + 20 AS BIGINT) AS w, CAST(l_linenumber * 20 + 20 AS BIGINT) AS h FROM lineitem"
_TEMPLATE_ROWS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(TEMPLATES))

_REGION_MERGE = """
WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS page, l_partkey * 7 % 900 AS x1, l_suppkey * 13 % 900 AS y1, CAST(l_quantity * 4 + 20 AS BIGINT) AS w, CAST(l_linenumber * 20 + 20 AS BIGINT) AS h FROM lineitem),
r AS (
  SELECT page, 0 AS step, list({'x1': x1, 'y1': y1, 'x2': x1 + w, 'y2': y1 + h}) AS boxes FROM b GROUP BY page
  UNION ALL
  SELECT page, step + 1, hulls FROM (
    SELECT page, step, boxes, list_distinct(list_transform(near, lambda n: {'x1': list_min(list_transform(n, lambda q: q.x1)), 'y1': list_min(list_transform(n, lambda q: q.y1)),
      'x2': list_max(list_transform(n, lambda q: q.x2)), 'y2': list_max(list_transform(n, lambda q: q.y2))})) AS hulls
    FROM (SELECT page, step, boxes, list_transform(boxes, lambda p: list_filter(boxes, lambda q: p.x1 <= q.x2 + 40 AND q.x1 <= p.x2 + 40 AND p.y1 <= q.y2 + 40 AND q.y1 <= p.y2 + 40)) AS near FROM r)
  ) WHERE list_sort(hulls) <> list_sort(boxes)
),
f AS (SELECT page, unnest(boxes) AS m FROM r QUALIFY step = max(step) OVER (PARTITION BY page))
SELECT page AS l_orderkey, m.x1 AS x, m.y1 AS y, m.x2 - m.x1 AS w, m.y2 - m.y1 AS h FROM f"""

ORACLE_SQL = {
    "region_merge": _REGION_MERGE,
    "strategy_score": """WITH r AS (SELECT event_type, TRY_CAST(props->>'$.k' AS INT) AS k, round(value, 2) AS latency FROM events), g AS (SELECT min(latency) AS lo, max(latency) AS hi FROM r),
      m AS (SELECT event_type, avg(CAST(k % 2 = 0 AS INT)) AS top1, avg(CAST(k % 3 = 0 AS INT)) AS top3, avg(CAST(k % 5 = 0 AS INT)) AS answer, avg(CAST(k % 7 = 0 AS INT)) AS hallucination, (avg(latency) - any_value(lo)) / greatest(any_value(hi) - any_value(lo), 1e-9) AS latency_norm FROM r, g GROUP BY 1)
      SELECT event_type, round(top1, 6) AS top1, round(top3, 6) AS top3, round(answer, 6) AS answer, round(hallucination, 6) AS hallucination, round(latency_norm, 6) AS latency_norm, round(0.4::DOUBLE * top1 + 0.2::DOUBLE * top3 + 0.35::DOUBLE * answer - 0.15::DOUBLE * hallucination - 0.05::DOUBLE * latency_norm, 6) AS score FROM m""",
    "ab_delta": """SELECT coalesce(o_orderpriority, 'global') AS scope, count(*) FILTER (o_orderkey % 2 = 0) AS a, count(*) FILTER (o_orderkey % 2 = 1) AS b,
      round(count(*) FILTER (o_orderkey % 2 = 1 AND o_orderstatus = 'O') / count(*) FILTER (o_orderkey % 2 = 1) - count(*) FILTER (o_orderkey % 2 = 0 AND o_orderstatus = 'O') / count(*) FILTER (o_orderkey % 2 = 0), 6) AS delta FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())""",
    "offline_online_delta": "SELECT c_custkey AS id, CAST(floor(c_acctbal) AS BIGINT) AS offline, CAST(floor(m) AS BIGINT) AS online, CAST(floor(m) AS BIGINT) - CAST(floor(c_acctbal) AS BIGINT) AS delta FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey",
    "coverage_pct": """SELECT lang, count(*) AS docs, floor(count(quality) * 1000 / count(*) + 0.5) / 10 AS labelled_pct, floor(count(*) FILTER (toxic = 1) * 1000 / count(*) + 0.5) / 10 AS toxic_pct, floor(count(text) * 1000 / count(*) + 0.5) / 10 AS with_text_pct
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    "score_labels": """WITH s AS (SELECT source, count(*) AS docs, count(*) FILTER (length(coalesce(text, '')) >= 100) AS long FROM documents GROUP BY 1), p AS (SELECT *, floor(long * 1000 / docs + 0.5) / 10 AS pct FROM s)
      SELECT *, CASE WHEN pct >= 95 THEN 'excellent' WHEN pct >= 85 THEN 'good' WHEN pct >= 70 THEN 'acceptable' ELSE 'low' END AS band FROM p""",
    "full_outer_cards": """WITH h AS (SELECT DISTINCT text[1:40] AS h FROM benchmark WHERE length(text) >= 40), d AS (SELECT DISTINCT doc_id, 1 AS leak FROM documents, h WHERE contains(text, h))
      SELECT coalesce(l.doc_id, d.doc_id) AS doc_id, quality, leak FROM labels l FULL JOIN d ON l.doc_id = d.doc_id""",
    "anti_join_gate": "SELECT source, count(*) AS unlabelled FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1",
    "duplicate_gate": "SELECT md5(coalesce(text, '')) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "schema_validator": """WITH d AS (SELECT count(*) AS n, count(*) FILTER (doc_id IS NULL) AS a, count(*) FILTER (coalesce(lang NOT IN ('en', 'fr', 'de'), true)) AS b, count(*) FILTER (coalesce(n_chars < 100, true)) AS c, count(*) FILTER (coalesce(n_chars <> length(text), true)) AS d FROM documents),
      e AS (SELECT count(*) AS n, count(*) FILTER (coalesce(value < 0, true)) AS a, count(*) FILTER (coalesce(event_type NOT IN ('click', 'view'), true)) AS b, count(*) FILTER (NOT coalesce(json_valid(props), false)) AS c FROM events)
      SELECT 'documents' AS table_name, 'doc_id_required' AS rule, a AS violations, n AS rows FROM d UNION ALL SELECT 'documents', 'lang_enum', b, n FROM d UNION ALL SELECT 'documents', 'n_chars_minimum', c, n FROM d UNION ALL SELECT 'documents', 'n_chars_is_length', d, n FROM d
      UNION ALL SELECT 'events', 'value_minimum', a, n FROM e UNION ALL SELECT 'events', 'type_enum', b, n FROM e UNION ALL SELECT 'events', 'props_json', c, n FROM e""",
    "placeholder_gate": r"SELECT page_id, CAST(len(regexp_extract_all(html, '\[IMAGE ATTACHED\]|&copy;|TODO')) AS INT) AS n FROM pages WHERE n > 0",
    "cross_template": f"SELECT template, r_name, replace(q, '{{name}}', r_name) AS question FROM (VALUES {_TEMPLATE_ROWS}) AS t(template, q), region",
    "card_text": """SELECT o_orderkey, concat_ws(chr(10), 'ISSUE: ' || o_orderkey, 'STATE: ' || o_orderstatus, 'OPEN: ' || CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END, 'AUTHOR: ' || coalesce(c_name, 'None'), CASE WHEN c_acctbal > 0 THEN 'SEGMENT: ' || c_mktsegment END, 'NATION: ' || n_name) AS card
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "markdown_card": r"""SELECT doc_id, array_to_string(list_transform(list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '[\t\r]', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')[1:3], lambda x: '- ' || x), chr(10)) AS card FROM documents""",
    "evidence_cards": """WITH s AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS s, list_sort(list(DISTINCT l_partkey)) AS p FROM lineitem GROUP BY 1)
      SELECT l_orderkey, array_to_string(list_concat(['issue:' || l_orderkey], list_transform(s[1:2], lambda x: 'pr:' || x), list_transform(p, lambda x: 'commit:' || x))[1:6], ' ') AS refs FROM s""",
    "component_split": "SELECT p_brand, count(*) AS parts, count(DISTINCT p_type) AS types, min(p_partkey) AS first, max(p_size) AS largest FROM part GROUP BY 1",
    "tag_mapping": "WITH t AS (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'NATION_' || c_nationkey END AS tag FROM customer) SELECT tag, n_nationkey AS tag_id, n_nationkey IS NULL AS unresolved FROM t LEFT JOIN nation ON upper(tag) = upper(n_name)",
    "union_summary": "SELECT o_orderstatus AS name, count(*) AS n, 'status' AS kind FROM orders GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*), 'segment' FROM customer GROUP BY 1",
    "weighted_score": "WITH s AS (SELECT p_size, count(*) AS w, floor(max(p_retailprice)) AS s FROM part GROUP BY 1) SELECT round(sum(w * s) / sum(w), 6) AS score FROM s",
    "bbox_overlap": f"""WITH b AS ({_BOX}), p AS (SELECT a.l_orderkey, CAST(greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0) AS BIGINT) AS area FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND (a.x, a.y, a.w, a.h) < (b.x, b.y, b.w, b.h))
      SELECT l_orderkey, count(*) AS pairs, CAST(sum(area) AS BIGINT) AS area FROM p WHERE area > 0 GROUP BY 1""",
}
