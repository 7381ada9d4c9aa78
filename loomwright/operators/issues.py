"""Issues and files as documents, and the texts of their cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.paths import example_name, file_id
from loomwright.functions.rules import ANCHOR, board, component, let, lower_all, series_of, text_of
from loomwright.functions.text import blob_url, compact_comments, first_sentence, lead, normalize_whitespace, slugify, strip, truncate_text
from loomwright.operators.cards import flag_text, none_text
from loomwright.operators.windows import ordered_distinct

# Words that are no value, fallbacks and constraints of the cards, bounds of their parts.
NO_VALUE = ("unknown", "other", "n/a")
NO_CAUSE, NO_FIX = "Not explicitly stated in issue thread.", "Inspect issue details and follow accepted workaround."
ISSUE_CONSTRAINT = "Constraints: Validate against exact MCU/board configuration and CubeMX/CubeH7 version before applying."
FILE_CONSTRAINT = "Constraints: Validate against exact STM32 series/board and firmware package before applying."
NO_SUMMARY = "Technical reference document extracted from STM32Cube repository."
SUMMARY_CHARS, TECHNICAL_CHARS = 360, 20000
TRAITS = ("mcu_series", "board", "layer", "component", "issue_kind", "severity")


def main_and_comments(c: Column) -> Column:
    """struct(main, comments) of an issue's text: without its title and body head, cut at the `Comments:` line."""
    mark = "\n\nComments:\n"

    def cut(bare: Column, at: Column) -> Column:
        return F.struct(F.when(at > 0, strip(F.substring(bare, F.lit(1), at - 1))).otherwise(bare).alias("main"), F.when(at > 0, strip(F.substring(bare, at + len(mark), F.length(bare)))).otherwise("").alias("comments"))

    return let(strip(F.regexp_replace(text_of(c), r"(?s)^Title:\s*.*?\n\nBody:\n", "")), lambda bare: let(F.instr(bare, mark), lambda at: cut(bare, at)))


def hint(c: Column, most: int) -> Column:
    """The first sentence of a text with single spaces, without marks of images."""
    return lead(F.trim(F.regexp_replace(c, r"\[IMAGE ATTACHED\]\s*", "")), most)


def issue_keywords(labels: Column, main: Column, most: int = 12) -> Column:
    """Traits that have a value, labels, and up to 20 names of the text that look technical; each once whatever its case."""
    none = F.array().cast("array<string>")
    traits = F.filter(F.array(*(F.trim(text_of(F.col(k))) for k in TRAITS)), lambda v: (v != "") & ~F.lower(v).isin(*NO_VALUE))
    given = F.filter(F.transform(F.coalesce(labels, none), lambda x: F.trim(text_of(x))), lambda x: x != "")
    return ordered_distinct(F.concat(traits, given, F.slice(F.regexp_extract_all(text_of(main), F.lit(ANCHOR), F.lit(1)), 1, 20)), most)


def issue_text(comments_chars: int = 4000) -> Column:
    """The text of an issue's card, from the columns of the issue: repo, mcu_series, board, component, layer, issue_kind, severity,
    evidence_strength, rescue_applied, state, issue_number, issue_title, labels, github_url, clean_text."""
    told = lambda both: F.struct(normalize_whitespace(both["main"]).alias("main"), normalize_whitespace(compact_comments(both["comments"], comments_chars)).alias("comments"))
    return let(let(main_and_comments(F.col("clean_text")), told), lambda x: _issue_text(x["main"], x["comments"]))


def _issue_text(main: Column, comments: Column) -> Column:
    shown = [("repo", none_text(F.col("repo"))), *((k, none_text(F.col(k))) for k in ("mcu_series", "board", "component", "layer", "issue_kind", "severity", "evidence_strength")),
             ("rescue_applied", flag_text(F.col("rescue_applied"))), ("state", none_text(F.col("state"))), ("issue_number", none_text(F.col("issue_number")))]
    context = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), v) for k, v in shown))
    or_text = lambda c, other: let(c, lambda x: F.when(x != "", x).otherwise(other))
    lines = [
        F.concat(F.lit("Problem: "), normalize_whitespace(F.col("issue_title"))), F.concat(F.lit("Context: "), context), F.concat(F.lit("Source URL: "), or_text(normalize_whitespace(F.col("github_url")), "Not available")),
        F.concat(F.lit("Root cause: "), or_text(hint(or_text(comments, main), 260), NO_CAUSE)), F.concat(F.lit("Fix: "), or_text(hint(main, 320), NO_FIX)), F.lit(ISSUE_CONSTRAINT),
        F.concat(F.lit("Keywords: "), F.array_join(issue_keywords(F.col("labels"), main), ", ")), F.lit(""), F.lit("Technical details:"), main, F.when(comments != "", F.concat(F.lit("\nKey comments:\n"), comments)),
    ]
    return strip(F.concat_ws("\n", *lines))


def issue_markdown(text: Column, title: str) -> Column:
    """A card as Markdown: its first 12 lines as a list under `## Metadata`, the rest as body."""
    def told(rows: Column) -> Column:
        head = F.transform(F.slice(rows, 1, 12), lambda x: F.concat(F.lit("- "), x))
        return F.concat(strip(F.concat_ws("\n", F.lit(f"# {title}"), F.lit(""), F.lit("## Metadata"), F.array_join(head, "\n"), F.lit(""), strip(F.array_join(F.slice(rows, 13, 1 << 30), "\n")))), F.lit("\n"))

    return let(F.split(text_of(text), "\n"), told)


def markdown_name(number: Column, title: Column) -> Column:
    return F.concat(F.lit("issue_"), none_text(number), F.lit("_"), slugify(F.coalesce(F.nullif(title, F.lit("")), F.lit("issue"))), F.lit(".md"))


def file_text(summary_chars: int = SUMMARY_CHARS, technical_chars: int = TECHNICAL_CHARS) -> Column:
    """The text of a file's card, from the columns of the file: repo, mcu_series, file_type, path, board, component, category,
    example_name, images_count, content_extractor, clean_text."""
    clean = normalize_whitespace(F.col("clean_text"))
    cut = truncate_text(clean, technical_chars)
    details = F.when(cut["truncated"], F.concat(cut["text"], F.lit(" [technical_details_truncated original_chars="), F.length(clean).cast("string"), F.lit(" kept_chars="), F.length(cut["text"]).cast("string"), F.lit("]"))).otherwise(cut["text"])
    context = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), none_text(F.col(k))) for k in ("repo", "mcu_series", "file_type", "path", "board", "component", "category", "example_name")))
    snippet = first_sentence(clean, summary_chars)
    lines = [
        F.concat(F.lit("Document: "), F.coalesce(F.nullif(F.col("path"), F.lit("")), F.lit("unknown"))), F.concat(F.lit("Context: "), context), F.concat(F.lit("Summary: "), F.when(snippet != "", snippet).otherwise(NO_SUMMARY)),
        F.concat(F.lit("Visual assets: "), F.coalesce("images_count", F.lit(0)).cast("string")), F.concat(F.lit("Content extractor: "), F.coalesce(F.nullif(F.col("content_extractor"), F.lit("")), F.lit("text"))),
        F.lit(FILE_CONSTRAINT), F.lit(""), F.lit("Technical details:"), details,
    ]
    return strip(F.concat_ws("\n", *lines))


def file_documents(files: DataFrame, least: int = 100) -> DataFrame:
    """Clean files (repo, path, clean_text, file_type) with id, series, board, component, example and validity."""
    seen = F.concat(text_of("path"), F.lit("\n"), text_of("clean_text"))
    return files.withColumns({
        "id": file_id(F.col("repo"), F.col("path")), "source_kind": F.lit("file"), "mcu_package": F.col("repo"), "mcu_series": series_of(F.col("repo")), "file_type": F.coalesce(F.nullif(F.col("file_type"), F.lit("")), F.lit("other")),
        "board": board(seen), "component": component(seen), "category": F.lit(None).cast("string"), "example_name": example_name(F.col("path")), "is_valid": F.length(text_of("clean_text")) >= least,
    })


#: Columns of a clean file that may be missing, with their types.
OPTIONAL = {"github_url": "string", "media_urls": "array<string>", "image_records": "array<struct<image_url:string>>", "images_count": "bigint", "content_extractor": "string", "pdf_task_file": "string"}


def file_records(files: DataFrame, owner: str, least: int = 100, version: str = "v2.0") -> DataFrame:
    """The whole record of each clean file: that of file_documents with address, images, extractor and version.

    Columns of OPTIONAL that files do not have count as null. An address that is given stays; else it is made of repository and path,
    and is null where one of them is missing or empty. Images are counted from their records where no count is given, or 0. Ids hang on
    repository and path alone; an id by the hash of one interpreter run, which no other run gives again, is not made."""
    known = files.withColumns({c: F.lit(None).cast(t) for c, t in OPTIONAL.items() if c not in files.columns})
    docs = file_documents(known.withColumn("path", text_of("path")).withColumn("clean_text", text_of("clean_text")), least)
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    slashed = F.regexp_replace(F.replace("path", F.lit("\\"), F.lit("/")), "^/+", "")
    made = F.when((text_of("repo") != "") & (F.col("path") != ""), blob_url(owner, F.col("repo"), slashed))
    counted = F.coalesce(F.nullif(F.col("images_count").cast("long"), F.lit(0)), F.size(F.coalesce("image_records", F.array())).cast("long"))
    return docs.withColumns({
        "type": F.lit("file"), "github_url": F.coalesce(given("github_url"), made), "ingest_version": F.lit(version), "image_urls": F.coalesce("media_urls", F.array().cast("array<string>")), "images_count": counted,
        "content_extractor": F.coalesce(given("content_extractor"), F.lit("text")),
    }).drop("media_urls")


def plain_documents(issues: DataFrame, version: str = "v1.0") -> DataFrame:
    """Clean issues as plain documents: id, series and whether a label confirms a bug; no other trait."""
    bug = F.arrays_overlap(lower_all(F.col("labels")), F.array(F.lit("bug"), F.lit("internal bug tracker")))
    empty = {k: F.lit(None).cast("string") for k in ("path", "board", "category", "component", "example_name")}
    return issues.withColumns({
        "id": F.concat(F.lower(text_of("repo")), F.lit("-issue-"), none_text(F.col("issue_number"))), "source_kind": F.lit("issue"), "mcu_package": F.col("repo"), "mcu_series": series_of(F.col("repo")), "type": F.lit("issue"), **empty,
        "issue_title": text_of("title"), "is_confirmed_bug": bug, "ingest_version": F.lit(version), "clean_text": text_of("clean_text"),
    })


def whole_chunks(issues: DataFrame, version: str = "v1.0") -> DataFrame:
    """One chunk for each issue, its whole text, with the plain document as metadata."""
    docs = plain_documents(issues, version)
    meta = F.struct(*(c for c in docs.columns if c not in ("clean_text", "id", "title")), F.lit(0).alias("chunk_index"), F.lit(1).alias("chunk_count"))
    return docs.select(F.concat("id", F.lit("-0")).alias("id"), F.col("clean_text").alias("text"), meta.alias("metadata"))


def requests_in_scope(prs: DataFrame, scope: str) -> DataFrame:
    """Requests whose commits are read: all, linked_only, merged_only, else merged or linked ones."""
    linked = F.size(F.coalesce("linked_issue_numbers", F.array())) > 0
    merged = F.coalesce("merged", F.lit(False))
    return {"all": prs, "linked_only": prs.where(linked), "merged_only": prs.where(merged)}.get(scope, prs.where(merged | linked))


def commits_in_order(commits: DataFrame) -> DataFrame:
    """Commits by time, then sha; those without a time first. A sort by range, so no task holds all of them."""
    return commits.orderBy(text_of("committed_at"), "sha")
