"""Audits and gates of a delivery: unlinked issues, summaries against their files, images, splits, uploads, declared modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.paths import repo_slug
from loomwright.functions.rules import text_of
from loomwright.operators import ranges
from loomwright.operators.quality import missing
from loomwright.operators.tagging import COMPONENTS, normalize_component, unlinked_reason, vote_component
from loomwright.operators.windows import top_per_key

#: A description below this many characters is short; a source from this size is split; parts of a split (fixed values).
SHORT, SPLIT_BYTES, PART_DOCS, PART_BYTES = 20, 350 * 1024, 8, 220 * 1024


def reasons(links: DataFrame) -> DataFrame:
    """Unlinked issues with why they are: links has arrays explicit_pr_numbers, explicit_commit_shas, message_inferred_commit_shas, commits_via_linked_prs, merge_like_commit_shas."""
    some = lambda c: F.size(F.coalesce(F.col(c), F.array())) > 0
    evidence = ("explicit_pr_numbers", "explicit_commit_shas", "message_inferred_commit_shas", "commits_via_linked_prs", "merge_like_commit_shas")
    return links.where("resolution_status = 'unlinked'").withColumn("reason", unlinked_reason(*map(some, evidence)))


def unlinked_audit(links: DataFrame, samples: int = 25) -> DataFrame:
    """(reason, issues, samples) over unlinked issues: how many, and the first issue numbers, at most `samples` (a report's limit)."""
    why = reasons(links)
    first = top_per_key(why.select("reason", "issue_number"), ["reason"], [F.col("issue_number")], samples)
    shown = first.groupBy("reason").agg(F.sort_array(F.collect_list("issue_number")).alias("samples"))
    return why.groupBy("reason").agg(F.count(F.lit(1)).alias("issues")).join(shown, "reason")


def unlinked_labels(links: DataFrame, most: int = 20) -> DataFrame:
    """The most frequent labels of unlinked issues (a report's limit), ties by label."""
    labels = links.where("resolution_status = 'unlinked'").select(F.explode("issue_labels").alias("label")).select(F.trim("label").alias("label")).where("label <> ''")
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(most)


def unlinked_rate(links: DataFrame) -> DataFrame:
    n, out = F.count(F.lit(1)), F.count_if(F.col("resolution_status") == "unlinked")
    return links.agg(n.alias("issues_total"), out.alias("unlinked_issues"), F.when(n == 0, 0.0).otherwise(F.bround(out / n, 4)).alias("unlinked_rate"))


def summary_problems(stored: DataFrame, counted: DataFrame, key: str = "name") -> DataFrame:
    """(name, stored, counted, status): numbers that a summary states against numbers counted again; missing ones read as 0."""
    both = stored.select(key, F.col("n").alias("_s")).join(counted.select(key, F.col("n").alias("_c")), key, "full_outer")
    rows = both.select(key, F.coalesce("_s", F.lit(0)).alias("stored"), F.coalesce("_c", F.lit(0)).alias("counted"))
    return rows.withColumn("status", F.when(F.col("stored") == F.col("counted"), "ok").otherwise("warning"))


def image_stats(images: DataFrame, group: str | None = None) -> DataFrame:
    """Images with and without a description, empty and short ones, and the mean length of descriptions, for each group."""
    told = text_of(F.coalesce(F.nullif(F.col("alfred_description"), F.lit("")), F.col("description")))
    n = F.length(F.regexp_replace(told, r"^\s+|\s+$", ""))
    empty = F.coalesce(F.nullif(F.col("alfred_description"), F.lit("")), F.col("description")) == ""
    rows = images.select(*([group] if group else []), n.alias("_n"), empty.alias("_empty"))
    return rows.groupBy(*([group] if group else [])).agg(
        F.count(F.lit(1)).alias("total_images"), F.count_if(F.col("_n") > 0).alias("with_description"), F.count_if(F.col("_n") == 0).alias("without_description"), F.count_if(F.col("_empty")).alias("empty_description"),
        F.count_if((F.col("_n") > 0) & (F.col("_n") < SHORT)).alias("short_descriptions"), F.coalesce(F.bround(F.avg(F.when(F.col("_n") > 0, F.col("_n"))), 1), F.lit(0.0)).alias("avg_description_length"),
    )


def delivery_counts(delivered: dict[str, DataFrame]) -> DataFrame:
    """(artifact, n): rows of each delivered table."""
    frames = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("artifact"), "n") for name, df in delivered.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def placeholder_gate(rows: DataFrame, text: str, pattern: str, level: str = "Fail") -> int:
    """How many rows still hold a placeholder; with Fail such rows are an error, with Warn a number, with Off nothing is looked at."""
    if level not in ("Fail", "Warn", "Off"):
        raise ValueError(f"unknown level {level}")
    if level == "Off":
        return 0
    found = rows.where(text_of(text).rlike(pattern)).count()
    if found and level == "Fail":
        raise ValueError(f"{found} rows hold placeholders")
    return found


def upload_problem(processor: Column, root: Column, roots: Column) -> Column:
    """Why a payload with arrays under `roots` (array of keys; none: an array itself) does not fit its target; null where it does."""
    kind = F.upper(F.trim(text_of(processor)))
    wanted = F.lower(F.trim(text_of(root)))
    bad = (
        F.when(kind == "STANDARD", "standard_needs_array").when((kind == "JSON") & (wanted == ""), "root_missing").when((kind == "JSON") & ~F.array_contains(F.transform(roots, F.lower), wanted), "root_differs")
        .when(kind == "", "processor_unknown")
    )
    return F.when(F.size(roots) > 0, bad)


def needs_split(size: Column, docs: Column, least: int = SPLIT_BYTES, most_docs: int = PART_DOCS, target: int = 0) -> Column:
    """Whether a source is split: large enough, and more rows than a part may have (or than parts are wanted)."""
    return (size >= least) & (docs > F.lit(target if target > 0 else most_docs))


def halved(rows: DataFrame, keys: Sequence[str], part: str, order: str, size: Column, most: int = PART_BYTES, out: str = "sub_part") -> DataFrame:
    """Parts cut into halves, and these again, until each is within `most` bytes or one row; sub parts are numbered from 0 in order. See ranges.halves."""
    return ranges.halves(rows, [*keys, part], [order], size, most, out)


def undeclared_modules(declared: DataFrame, configured: DataFrame) -> DataFrame:
    """Declared modules (path, url) whose repository is in no configuration (repo: a name or an address)."""
    known = configured.select(repo_slug(F.col("repo")).alias("slug"))
    return missing(declared.withColumn("slug", repo_slug(F.col("url"))), known, ["slug"])


def component_detection(issues: DataFrame, component: str = "component", text: str = "st_ready_text", labels: str = "labels") -> DataFrame:
    """Issues with the component that a split goes by, and where it is from: the field, the text, or nowhere."""
    own = normalize_component(F.col(component))
    voted = vote_component(F.col(text), F.col(labels))
    known = own.isin(*COMPONENTS)
    return issues.withColumn("split_component", F.when(known, own).otherwise(F.coalesce(voted, F.lit("UNKNOWN")))).withColumn("detection_source", F.when(known, "component_field").when(voted.isNotNull(), "st_ready_text").otherwise("none"))


def series_tag(series: Column, repo: Column, path: Column) -> Column:
    """A short tag of a payload's series: from its field, its repository or its path; UNK without any."""
    bare = lambda c: F.regexp_replace(F.upper(F.trim(text_of(c))), "[^A-Z0-9]+", "")
    own, up = bare(series), F.upper(F.trim(text_of(repo)))
    named = F.when(up.startswith("STM32CUBE"), F.regexp_replace(F.substring(up, 10, 1 << 30), "[^A-Z0-9]+", "")).otherwise("")
    found = F.upper(F.regexp_extract(text_of(path), r"(?i)stm32cube([a-z0-9]+)", 1))
    return F.when(F.trim(text_of(series)) != "", F.coalesce(F.nullif(own, F.lit("")), F.lit("UNK"))).otherwise(F.coalesce(F.nullif(named, F.lit("")), F.nullif(found, F.lit("")), F.lit("UNK")))


def split_mixed(rows: DataFrame, kind: str, roots: dict[str, str], root_col: str = "rootTagPath") -> dict[str, DataFrame]:
    """Rows of a mixed payload by kind, each with the root under which it is delivered."""
    return {name: rows.where(F.col(kind) == name).withColumn(root_col, F.lit(root)) for name, root in roots.items()}
