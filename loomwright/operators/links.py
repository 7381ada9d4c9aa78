"""Issues linked to pull requests and commits, with scored evidence.

Entities: issues(issue_number), prs(pr_number, merged, changed_files, linked_issue_numbers array),
commits(sha, message, linked_issue_numbers array, pr_numbers array). Array keys are exploded and joined
on equality; each issue's sets meet in one aggregate on issue_number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.rules import commit_issue_numbers, ordered_case, text_of


def is_merge(message: Column) -> Column:
    return F.lower(F.trim(text_of(message))).rlike("^merge (branch|pull request)")


def link_score(prs: Column, merged: Column, commits: Column, files: Column) -> Column:
    """From counts of referring and merged requests, of commits that are no merges, and whether a merged request changed files."""
    score = (
        F.when(prs > 0, 0.5).otherwise(0.0)
        + F.when(merged > 0, 0.3).when(prs > 0, 0.1).otherwise(0.0)
        + F.when(commits > 0, 0.2).otherwise(0.0)
        + F.when((prs == 0) & (commits > 0), 0.15).otherwise(0.0)
        + F.when((merged > 0) & files & (commits == 0), 0.08).otherwise(0.0)
    )
    return F.bround(F.least(score, F.lit(1.0)), 2)


def confidence(score: Column) -> Column:
    return ordered_case([(score >= 0.9, "high"), (score >= 0.5, "medium"), (score > 0, "low")], "none")


def resolution(prs: Column, merged: Column, commits: Column, files: Column) -> Column:
    return ordered_case(
        [((merged > 0) & ((commits > 0) | files), "merged_fix"), ((prs > 0) & (commits > 0), "candidate_fix"), (commits > 0, "commit_only_candidate"), (prs > 0, "reference_only")], "unlinked"
    )


def link_issues(issues: DataFrame, prs: DataFrame, commits: DataFrame) -> DataFrame:
    """One row for each issue: sorted linked numbers and shas, evidence counts, score, confidence, status."""
    pr_refs = prs.select(F.explode("linked_issue_numbers").alias("issue_number"), "pr_number", "merged", (F.col("merged") & (F.col("changed_files") > 0)).alias("filed")).distinct()
    explicit = commits.select(F.explode("linked_issue_numbers").alias("issue_number"), "sha", is_merge(F.col("message")).alias("merge"))
    inferred = commits.select(F.explode(F.array_except(commit_issue_numbers(F.col("message")), F.coalesce("linked_issue_numbers", F.array().cast("array<bigint>")))).alias("issue_number"), "sha", is_merge(F.col("message")).alias("merge"))
    through = commits.select(F.explode("pr_numbers").alias("pr_number"), "sha", is_merge(F.col("message")).alias("merge")).join(pr_refs.select("pr_number", "issue_number"), "pr_number").select("issue_number", "sha", "merge")
    commit_refs = explicit.unionByName(inferred).unionByName(through)
    by_pr = pr_refs.groupBy("issue_number").agg(
        F.sort_array(F.collect_set("pr_number")).alias("linked_pr_numbers"), F.count_distinct(F.when(F.col("merged"), F.col("pr_number"))).alias("merged_prs"), F.max("filed").alias("filed")
    )
    by_commit = commit_refs.groupBy("issue_number").agg(F.sort_array(F.collect_set("sha")).alias("linked_commit_shas"), F.count_distinct(F.when(~F.col("merge"), F.col("sha"))).alias("commits"))
    joined = issues.join(by_pr, "issue_number", "left").join(by_commit, "issue_number", "left")
    none = F.array().cast
    full = joined.select(
        *issues.columns,
        F.coalesce("linked_pr_numbers", none("array<bigint>")).alias("linked_pr_numbers"),
        F.coalesce("linked_commit_shas", none("array<string>")).alias("linked_commit_shas"),
        F.coalesce("merged_prs", F.lit(0)).alias("merged_prs"),
        F.coalesce("commits", F.lit(0)).alias("meaningful_commits"),
        F.coalesce("filed", F.lit(False)).alias("file_evidence"),
    )
    counts = (F.size("linked_pr_numbers"), F.col("merged_prs"), F.col("meaningful_commits"), F.col("file_evidence"))
    return full.withColumn("link_score", link_score(*counts)).withColumn("link_confidence", confidence(F.col("link_score"))).withColumn("resolution_status", resolution(*counts))


def link_summary(links: DataFrame) -> DataFrame:
    """One row: totals, counts by status, link rate to four places."""
    status = ("merged_fix", "candidate_fix", "commit_only_candidate", "reference_only")
    return links.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("link_score") > 0).alias("linked"),
        *(F.count_if(F.col("resolution_status") == s).alias(s) for s in status),
        F.bround(F.count_if(F.col("link_score") > 0) / F.count(F.lit(1)), 4).alias("link_rate"),
    )


def commit_union(commits: DataFrame) -> DataFrame:
    """One row for each sha with the unions of its request and issue numbers, in commit order."""
    return commits.groupBy("sha").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pr_numbers")))).alias("pr_numbers"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("linked_issue_numbers")))).alias("linked_issue_numbers")
    )
