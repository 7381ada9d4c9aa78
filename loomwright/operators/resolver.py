"""Resolver cases: what is known of the fix of a linked issue, with the files that its commits changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.rules import let, ordered_case, text_of
from loomwright.functions.text import first_sentence, normalize_path, normalize_whitespace, request_body, unescaped_url
from loomwright.operators.cards import none_text
from loomwright.operators.tagging import module_of_key
from loomwright.operators.windows import prefer

# What a status says, and the last lines of a case's text.
ASSESSMENTS = (
    ("merged_fix", "Fix likely integrated in mainline; prefer this as primary recommendation."),
    ("candidate_fix", "Potential fix identified, but integration status is uncertain."),
    ("commit_only_candidate", "Commit-level evidence exists, but PR linkage is incomplete."),
    ("reference_only", "Reference link exists without enough technical fix evidence."),
    ("unlinked", "No actionable fix linkage detected."),
)
OTHER_ASSESSMENT = "Potential fix linkage requires validation."
FILE_LINE = "File evidence: merged PR modifies files even when commit log is merge-heavy"
LAST_LINE = "Constraints: Validate against exact MCU series, board, firmware package version, and local project config before applying."
#: The requests of a case whose bodies are shown (fixed value).
BODIES = 2
#: What a changed file that is also a document scores above its changes (fixed value).
MATCHED = 20.0


def wanted(cases: DataFrame, reference_only: bool = False) -> DataFrame:
    """Cases with a link; those with a reference alone on demand."""
    status = F.coalesce("resolution_status", F.lit("unlinked"))
    return cases.where(status != "unlinked") if reference_only else cases.where(~status.isin("unlinked", "reference_only"))


def linked_commits(cases: DataFrame, commits: DataFrame) -> DataFrame:
    """(issue_number, pos, sha, message, url, files_changed) of each linked commit that is known; shas compare without case.

    Of several rows with one sha the one with the most changed files stays, then the least message."""
    refs = cases.select("issue_number", F.posexplode("linked_commit_shas").alias("pos", "_sha")).select("issue_number", "pos", F.lower(F.trim("_sha")).alias("sha"))
    known = commits.select(F.lower(F.trim("sha")).alias("sha"), "message", F.col("github_url").alias("url"), "files_changed")
    # Rows of commits carry whole file lists, so those that no case names go before they are ranked.
    known = prefer(known.join(refs.select("sha").distinct(), "sha", "left_semi"), ["sha"], [F.desc(F.size("files_changed")), F.col("message"), F.col("url")])
    return refs.where("sha <> ''").join(known, "sha").select("issue_number", "pos", "sha", "message", "url", "files_changed")


def changed_files(linked: DataFrame) -> DataFrame:
    """(issue_number, path_key, path, status, additions, deletions, changes, touched_by_commits, commit_shas, module, seen), summed over commits.

    The status is the last one given, the path the first, seen where the file first occurs."""
    files = linked.select("issue_number", "pos", "sha", F.posexplode("files_changed").alias("at", "f"))
    rows = files.select("issue_number", "sha", F.struct("pos", "at").alias("seen"), normalize_path(F.col("f.filename")).alias("path_key"), F.col("f.filename").alias("filename"), F.nullif(F.col("f.status"), F.lit("")).alias("status"), *(F.coalesce(F.col(f"f.{c}"), F.lit(0)).alias(c) for c in ("additions", "deletions", "changes")))
    grouped = rows.where("path_key <> ''").groupBy("issue_number", "path_key").agg(
        F.min_by("filename", "seen").alias("filename"), F.max_by("status", F.when(F.col("status").isNotNull(), F.col("seen"))).alias("status"), *(F.sum(c).cast("long").alias(c) for c in ("additions", "deletions", "changes")),
        F.count(F.lit(1)).alias("touched_by_commits"), F.sort_array(F.collect_set("sha")).alias("commit_shas"), F.min("seen").alias("seen"),
    )
    return grouped.withColumn("path", F.regexp_replace(F.replace("filename", F.lit("\\"), F.lit("/")), "^/+", "")).withColumn("module", module_of_key(F.col("path_key"))).drop("filename")


def with_documents(files: DataFrame, documents: DataFrame, base_url: str, repo: Column) -> DataFrame:
    """Changed files with the document of the same path, a valid one before others; without one they are known from commits only."""
    docs = prefer(documents.select(normalize_path(F.col("path")).alias("path_key"), F.struct("id", "path", "file_type", "component", "board", "example_name", "github_url").alias("doc"), F.coalesce("is_valid", F.lit(True)).alias("_valid"), F.col("id").alias("_id")), ["path_key"], [F.desc("_valid"), F.col("_id")])
    out = files.join(docs.select("path_key", "doc"), "path_key", "left")
    url = F.coalesce(F.nullif(F.col("doc.github_url"), F.lit("")), unescaped_url(base_url, repo, F.col("path")))
    return out.select("*", F.when(F.col("doc").isNull(), "commit_only").otherwise("docs_files_exact").alias("source_match"), url.alias("github_url"), F.bround(F.col("changes") + F.when(F.col("doc").isNull(), 0.0).otherwise(MATCHED), 2).alias("score"))


def files_evidence(files: DataFrame) -> DataFrame:
    """One row for each issue: its files by changes and touches, match rate, and the sets of what is impacted."""
    record = F.struct((-F.col("changes")).alias("a"), (-F.col("touched_by_commits")).alias("b"), "seen", "path", "status", "additions", "deletions", "changes", "touched_by_commits", "commit_shas", "module", "source_match", "github_url", "score")
    some = lambda c: F.sort_array(F.collect_set(F.nullif(F.col(c), F.lit(""))))
    return files.groupBy("issue_number").agg(
        F.sort_array(F.collect_list(record)).alias("files"), F.count(F.lit(1)).alias("changed_files_total"), F.count("doc").alias("matched_docs_files_count"), F.bround(F.count("doc") / F.count(F.lit(1)), 4).alias("match_rate"),
        some("doc.id").alias("linked_file_ids"), some("doc.path").alias("linked_file_paths"), F.sort_array(F.collect_set(F.when(F.col("module") != "unknown", F.col("module")))).alias("impacted_modules"),
        some("doc.component").alias("impacted_components"), some("doc.board").alias("impacted_boards"), some("doc.file_type").alias("impacted_file_types"),
    ).withColumn("files", F.transform("files", lambda f: f.dropFields("a", "b", "seen"))).withColumn("primary_changed_file", F.get("files", F.lit(0)))


def link_evidence(prs_of: DataFrame, commits_of: DataFrame) -> DataFrame:
    """One row for each issue: _titles, linked_pr_urls, _bodies (of its first requests), _messages and linked_commit_urls, each in the order of
    the links. Requests and commits are one table, so an issue is grouped once."""
    empty = F.lit(None).cast
    requests = prs_of.select("issue_number", "pos", F.lit(True).alias("is_pr"), F.col("pr_number").cast("long").alias("number"), text_of("title").alias("told"), "url", "body")
    others = commits_of.select("issue_number", "pos", F.lit(False).alias("is_pr"), empty("long").alias("number"), text_of("message").alias("told"), "url", empty("string").alias("body"))
    told, url, body = F.col("told"), F.col("url"), F.struct(F.col("number").alias("pr_number"), "body")
    # collect_list leaves nulls out, so a value that does not belong to an array is null.
    listed = lambda where, value: F.transform(F.sort_array(F.collect_list(F.when(where, F.struct("pos", value.alias("v"))))), lambda x: x["v"])
    is_pr, has_url = F.col("is_pr"), F.col("url") != ""
    return requests.unionByName(others).groupBy("issue_number").agg(
        listed(is_pr, told).alias("_titles"), listed(is_pr & has_url, url).alias("linked_pr_urls"), listed(is_pr & (F.col("pos") < BODIES), body).alias("_bodies"),
        listed(~is_pr, told).alias("_messages"), listed(~is_pr & has_url, url).alias("linked_commit_urls"),
    )


def case_text(titles: Column, messages: Column, bodies: Column) -> Column:
    """The text of a case. titles and messages: arrays; bodies: array of struct(pr_number, body) of the first requests."""
    kept = lambda c, most: F.slice(F.filter(F.transform(c, normalize_whitespace), lambda x: x != ""), 1, most)
    status = F.coalesce(F.nullif(F.col("resolution_status"), F.lit("")), F.lit("unlinked"))
    labels = F.array_join(F.coalesce("issue_labels", F.array().cast("array<string>")), ", ")
    leads, heads = kept(F.transform(messages, lambda m: first_sentence(m, 180)), 4), kept(titles, 3)
    told = F.filter(F.transform(bodies, lambda b: F.struct(b["pr_number"].alias("n"), request_body(b["body"]).alias("t"))), lambda b: b["t"] != "")
    joined = lambda items, mark, label="": let(items, lambda xs: F.when(F.size(xs) > 0, F.concat(F.lit(label), F.array_join(xs, mark))))
    lines = F.transform(told, lambda b: F.concat(F.lit("PR #"), b["n"].cast("string"), F.lit(" description: "), b["t"]))
    return F.concat_ws(
        "\n", F.concat(F.lit("Problem: Issue #"), none_text(F.col("issue_number")), F.lit(" - "), normalize_whitespace(F.col("issue_title"))),
        F.concat(F.lit("Context: repo="), none_text(F.col("repo")), F.lit(", labels="), F.when(labels != "", labels).otherwise("none"), F.lit(", issue_state="), none_text(F.col("issue_state"))),
        F.concat(F.lit("Resolver signal: resolution_status="), status, F.lit(", confidence="), F.coalesce(F.nullif(F.col("link_confidence"), F.lit("")), F.lit("none")), F.lit(", score="), F.when(F.coalesce("link_score", F.lit(0.0)) == 0, "0").otherwise(F.col("link_score").cast("string"))),
        F.concat(F.lit("Assessment: "), ordered_case([(status == s, t) for s, t in ASSESSMENTS], OTHER_ASSESSMENT)),
        joined(heads, " | ", "Candidate PRs: "), joined(leads, " | ", "Commit evidence: "),
        F.when(F.coalesce("merged_pr_with_file_evidence", F.lit(False)), F.lit(FILE_LINE)),
        joined(lines, "\n"), F.lit(LAST_LINE),
    )


def request_bodies(prs_of: DataFrame, most: int = BODIES) -> DataFrame:
    """(issue_number, pos, pr_number, body) of a case's first requests: of its first numbers those that are known, no later ones in their place."""
    return prs_of.where(F.col("pos") < most).select("issue_number", "pos", "pr_number", "body")


def resolver_cases(cases: DataFrame, commits: DataFrame, prs: DataFrame, documents: DataFrame, base_url: str, reference_only: bool = False) -> DataFrame:
    """Cases with their text, links and file evidence.

    cases: repo, issue_number, issue_title, issue_labels, issue_state, issue_url, linked_pr_numbers, linked_commit_shas, link_score,
    link_confidence, resolution_status, merged_pr_with_file_evidence. Everything is joined on keys of one issue, commit, request or path."""
    kept = wanted(cases, reference_only)
    commits_of = linked_commits(kept, commits)
    pr_refs = kept.select("issue_number", F.posexplode("linked_pr_numbers").alias("pos", "pr_number"))
    prs_of = pr_refs.join(prs.select("pr_number", "title", "body", F.col("github_url").alias("url")), "pr_number")
    repos = kept.select("issue_number", "repo")
    files = files_evidence(with_documents(changed_files(commits_of).join(repos, "issue_number"), documents, base_url, F.col("repo")))
    out = kept.join(link_evidence(prs_of, commits_of), "issue_number", "left").join(files, "issue_number", "left")
    none = F.array().cast("array<string>")
    text = case_text(F.coalesce("_titles", none), F.coalesce("_messages", none), F.coalesce("_bodies", F.array().cast("array<struct<pr_number:bigint,body:string>>")))
    out = out.withColumn("resolver_card_text", text).withColumn("id", F.concat(F.lit("resolver::"), F.col("repo"), F.lit("::issue::"), F.col("issue_number").cast("string")))
    out = out.withColumn("primary_pr_number", F.get("linked_pr_numbers", F.lit(0))).withColumn("primary_commit_sha", F.get("linked_commit_shas", F.lit(0)))
    out = out.withColumns({c: F.coalesce(c, none) for c in ("linked_pr_urls", "linked_commit_urls", "linked_file_ids", "linked_file_paths", "impacted_modules", "impacted_components", "impacted_boards", "impacted_file_types")})
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("changed_files_total", "matched_docs_files_count", "match_rate")}).withColumn("unmatched_files_count", F.col("changed_files_total") - F.col("matched_docs_files_count")).drop("_titles", "_bodies", "_messages")


def summary(cases: DataFrame, exported: DataFrame) -> DataFrame:
    """One row: cases in and out, and counts by status."""
    counts = [F.count_if(F.col("resolution_status") == s).alias(s) for s, _ in ASSESSMENTS[:4]]
    out = exported.agg(F.count(F.lit(1)).alias("exported_cases"), *counts, F.count_if("merged_pr_with_file_evidence").alias("merged_pr_with_file_evidence_cases"))
    return out.crossJoin(cases.agg(F.count(F.lit(1)).alias("total_cases_in_input")))  # one row each
