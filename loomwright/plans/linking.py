"""Linking queries on orders (issues), distinct order and supplier pairs (requests) and lineitem (commits)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.operators import links, windows
from loomwright.session import table


def entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """issues, prs and commits from the test tables."""
    line = table(spark, sf_dir, "lineitem")
    issues = table(spark, sf_dir, "orders").where("o_orderkey > 0").select(F.col("o_orderkey").alias("issue_number"))
    pr = (F.col("l_orderkey") * 100000 + F.col("l_suppkey")).alias("pr_number")
    prs = line.where("l_quantity >= 20").groupBy("l_orderkey", "l_suppkey").agg(F.max(F.col("l_linestatus") == "F").alias("merged"), F.count_if(F.col("l_discount") > 0.05).alias("changed_files"))
    prs = prs.select(pr, "merged", "changed_files", F.array("l_orderkey").alias("linked_issue_numbers"))
    message = F.when(F.col("l_returnflag") == "A", F.lit("Merge branch 'x'")).otherwise(F.concat(F.lit("Fixes #"), F.col("l_orderkey")))
    commits = line.where("l_tax >= 0.03").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sha"), message.alias("message"), F.when(F.col("l_returnflag") == "A", F.array("l_orderkey")).otherwise(F.array().cast("array<bigint>")).alias("linked_issue_numbers"), F.array(pr).alias("pr_numbers")
    )
    return issues, prs, commits


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.link_issues(*entities(spark, sf_dir))


def link_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select("issue_number", F.size("linked_pr_numbers").alias("prs"), F.size("linked_commit_shas").alias("commits"), "merged_prs", "meaningful_commits", "link_score", "link_confidence", "resolution_status")


def link_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.link_summary(_links(spark, sf_dir))


def link_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = link_status(spark, sf_dir).orderBy(F.desc("prs"), F.desc("commits"), F.desc("link_score"), "issue_number").limit(20)
    return out.select("issue_number", "prs", "commits", "link_score")


def commit_dedupe_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    commits = line.select(F.col("l_partkey").alias("sha"), F.array("l_suppkey").alias("pr_numbers"), F.array("l_orderkey").alias("linked_issue_numbers"))
    out = links.commit_union(commits)
    return out.select("sha", F.array_join(F.col("pr_numbers").cast("array<string>"), ",").alias("prs"), F.array_join(F.col("linked_issue_numbers").cast("array<string>"), ",").alias("issues"))


def changed_files_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    grouped = line.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").cast("long").alias("changes"), F.count(F.lit(1)).alias("touched"), F.array_join(F.sort_array(F.collect_set(F.col("l_linenumber"))).cast("array<string>"), ",").alias("commits"), F.max(F.struct("l_linenumber", "l_linestatus"))["l_linestatus"].alias("status")
    )
    order = [F.desc("changes"), F.desc("touched"), F.col("l_suppkey")]
    return windows.top_per_key(grouped, ["l_orderkey"], order, 10, "rank")


def impacted_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").where("p_size > 5")
    joined = line.join(part, line["l_partkey"] == part["p_partkey"], "left")
    return joined.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("files"), F.count("p_partkey").alias("matched"), F.bround(F.count("p_partkey") / F.count(F.lit(1)), 4).alias("match_rate"), F.array_join(F.sort_array(F.collect_set("p_brand")), ",").alias("components")
    )


def case_request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two requests of each order with their supplier's name."""
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    first = windows.top_per_key(pairs, ["l_orderkey"], [F.col("l_suppkey")], 2, "rank")
    return first.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "rank", "s_name")


_BASE = """
WITH pr AS (
  SELECT l_orderkey, l_suppkey, bool_or(l_linestatus = 'F') AS merged, count(*) FILTER (l_discount > 0.05) AS files FROM lineitem WHERE l_quantity >= 20 GROUP BY ALL
), c AS (
  SELECT l_orderkey, l_linenumber, l_returnflag = 'A' AS mrg FROM lineitem WHERE l_tax >= 0.03
), p AS (
  SELECT l_orderkey, count(*) AS prs, count(*) FILTER (merged) AS merged_prs, coalesce(bool_or(merged AND files > 0), false) AS filed FROM pr GROUP BY 1
), k AS (
  SELECT l_orderkey, count(DISTINCT l_linenumber) AS commits, count(DISTINCT l_linenumber) FILTER (NOT mrg) AS mc FROM c GROUP BY 1
), j AS (
  SELECT o_orderkey AS issue_number, coalesce(prs, 0) AS prs, coalesce(commits, 0) AS commits, coalesce(merged_prs, 0) AS merged_prs, coalesce(mc, 0) AS meaningful_commits, coalesce(filed, false) AS filed
  FROM orders LEFT JOIN p ON o_orderkey = p.l_orderkey LEFT JOIN k ON o_orderkey = k.l_orderkey WHERE o_orderkey > 0
), s AS (
  SELECT *, round(least(1.0::DOUBLE, CASE WHEN prs > 0 THEN 0.5 ELSE 0 END + CASE WHEN merged_prs > 0 THEN 0.3 WHEN prs > 0 THEN 0.1 ELSE 0 END + CASE WHEN meaningful_commits > 0 THEN 0.2 ELSE 0 END
    + CASE WHEN prs = 0 AND meaningful_commits > 0 THEN 0.15 ELSE 0 END + CASE WHEN merged_prs > 0 AND filed AND meaningful_commits = 0 THEN 0.08 ELSE 0 END)::DOUBLE, 2) AS link_score,
    CASE WHEN merged_prs > 0 AND (meaningful_commits > 0 OR filed) THEN 'merged_fix' WHEN prs > 0 AND meaningful_commits > 0 THEN 'candidate_fix' WHEN meaningful_commits > 0 THEN 'commit_only_candidate' WHEN prs > 0 THEN 'reference_only' ELSE 'unlinked' END AS resolution_status FROM j
)
"""

QUERIES = {
    "link_status": link_status, "link_summary": link_summary, "link_top": link_top, "commit_dedupe_union": commit_dedupe_union, "changed_files_agg": changed_files_agg, "impacted_sets_match_rate": impacted_sets, "case_request_texts": case_request_texts,
}

ORACLE_SQL = {
    "link_status": _BASE + """SELECT issue_number, CAST(prs AS INT) AS prs, CAST(commits AS INT) AS commits, merged_prs, meaningful_commits, link_score,
      CASE WHEN link_score >= 0.9 THEN 'high' WHEN link_score >= 0.5 THEN 'medium' WHEN link_score > 0 THEN 'low' ELSE 'none' END AS link_confidence, resolution_status FROM s""",
    "link_summary": _BASE + """SELECT count(*) AS total, count(*) FILTER (link_score > 0) AS linked, count(*) FILTER (resolution_status = 'merged_fix') AS merged_fix, count(*) FILTER (resolution_status = 'candidate_fix') AS candidate_fix,
      count(*) FILTER (resolution_status = 'commit_only_candidate') AS commit_only_candidate, count(*) FILTER (resolution_status = 'reference_only') AS reference_only, round_even(count(*) FILTER (link_score > 0) / count(*), 4) AS link_rate FROM s""",
    "link_top": _BASE + "SELECT issue_number, CAST(prs AS INT) AS prs, CAST(commits AS INT) AS commits, link_score FROM s ORDER BY prs DESC, commits DESC, link_score DESC, issue_number LIMIT 20",
    "commit_dedupe_union": "SELECT l_partkey AS sha, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS prs, array_to_string(list_sort(list(DISTINCT l_orderkey)), ',') AS issues FROM lineitem GROUP BY 1",
    "changed_files_agg": """WITH g AS (SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS changes, count(*) AS touched, array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') AS commits, max(struct_pack(a := l_linenumber, b := l_linestatus)).b AS status FROM lineitem GROUP BY ALL)
      SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY changes DESC, touched DESC, l_suppkey) AS INT) AS rank FROM g QUALIFY rank <= 10""",
    "impacted_sets_match_rate": """SELECT l_orderkey, count(*) AS files, count(p_partkey) AS matched, round_even(count(p_partkey) / count(*), 4) AS match_rate, coalesce(array_to_string(list_sort(list(DISTINCT p_brand) FILTER (p_brand IS NOT NULL)), ','), '') AS components
      FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey GROUP BY 1""",
    "case_request_texts": """WITH d AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) AS INT) AS rank FROM d QUALIFY rank <= 2)
      SELECT l_orderkey, rank, s_name FROM r LEFT JOIN supplier ON l_suppkey = s_suppkey""",
}
