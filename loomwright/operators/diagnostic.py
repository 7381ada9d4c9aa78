"""Diagnostic cards: an issue card and a resolver case of one issue, composed into one record with its text.

All of it is Column work on one row of the full outer join, so cards scale with the join alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.rules import let, ordered_case, text_of
from loomwright.functions.text import first_sentence, is_plain_talk, lead, normalize_whitespace, slugify, split_items, technical_body
from loomwright.operators.cards import none_text
from loomwright.operators.tagging import api_tags, failure_tags, version_tags
from loomwright.operators.windows import ordered_distinct

# The sentences of a card, by what calls for them.
BLOCKING_ALIASES = ("HAL_SPI_Transmit_DMA blocking function", "small amount of data", "small transfer", "2 bytes", "2 bytes example")
STUCK_ALIASES = ("blocking function", "seems blocking", "blocking behavior", "callback not reached", "state stuck busy")
CALLBACK_CHECKS = ("Instrument callback entry points and verify state transitions around the failing call", "Check whether the peripheral state returns to READY after the operation")
COMPILE_CHECK = "Rebuild with the exact toolchain and package version referenced in the report"
TIMEOUT_CHECK = "Capture timeout path timing and compare it with clock and interrupt configuration"
MINIMAL_CHECK = "Reproduce on a minimal project using the same board, Cube package, and middleware settings"
PART_QUESTION = "Which exact MCU part number and board are you using?"
VERSION_QUESTION = "Which exact Cube/CubeMX/CubeIDE package versions are installed in your project?"
BUFFER_QUESTION = "Are DMA buffers cache-coherent and are clean/invalidate operations applied correctly?"
INTERRUPT_QUESTION = "Do interrupts/callbacks trigger as expected with the current NVIC priorities?"
BRANCH_WORKAROUND = "Test the candidate fix path or PR on an isolated branch before merging locally"
DMA_WORKAROUND = "Try an alternate transfer mode on a minimal case to isolate DMA-specific behavior"
PIN_WORKAROUND = "Pin a known-good firmware package version while validating the issue scope"
RESCUED_FACT = "The issue was rescued by the preprocessing filter because technical signals were detected"
LINKED_FACT = "A linked commit or pull request exists for this issue path"
MERGED_FACT = "A merged PR with changed-file evidence exists even if commit history is merge-heavy"
RESCUED_CONSTRAINT = "This card is derived from a rescued issue and still requires board-level validation"
WEAK_CONSTRAINT = "Linked fix evidence is not strong enough to assume universal applicability"
LAST_CONSTRAINT = "Validate against the exact MCU series, board, package version, and local integration path"
DIAGNOSES = (
    ("merged_fix", "A mainline fix likely exists, so local package drift is a plausible cause"),
    ("candidate_fix", "A candidate fix exists, suggesting the problem may already be understood upstream"),
    ("commit_only_candidate", "Commit-level evidence suggests an upstream fix candidate, but PR traceability is incomplete"),
)
VERSION_DIAGNOSIS = "Behavior may depend on the exact Cube or HAL version in use"
BLOCKED_DIAGNOSIS = "The application may be observing a completion-path or state-machine defect rather than a true hard block"
NO_DIAGNOSIS = "The issue requires targeted reproduction to distinguish configuration error from upstream defect"
NO_CAUSE = "Root cause is not explicit; use the issue thread and linked changes for triage"
NO_HYPOTHESIS = "No strong hypothesis yet; prioritize targeted checks and reproduction"
UNTITLED = "Untitled diagnostic case"
MISSING_WORDS = ("none", "unknown", "other", "n/a")
SERIES = r"(H\d+|F\d+|L\d+|G\d+|U\d+|WB\d+|WL\d+|MP\d+)"


def tidy(items: Column) -> Column:
    """Items with single spaces."""
    return F.transform(items, normalize_whitespace)


def few(items: Column, most: int) -> Column:
    """Of items that have single spaces those that are not empty, each once whatever its case, at most so many."""
    return ordered_distinct(F.filter(items, lambda x: x != ""), most)


def some(condition: Column | None, *items: Column | str) -> Column:
    """The items where the condition holds, else none."""
    found = F.array(*(F.lit(x) if isinstance(x, str) else x for x in items))
    return found if condition is None else F.when(F.coalesce(condition, F.lit(False)), found).otherwise(F.array().cast("array<string>"))


def or_else(items: Column, fallback: str) -> Column:
    return let(items, lambda xs: F.when(F.size(xs) > 0, xs).otherwise(F.array(F.lit(fallback))))


def signal(c: Column, most: int) -> Column:
    """signal_sentence of a text that is computed once."""
    return let(first_sentence(c, most), lambda s: F.when(is_plain_talk(s), "").otherwise(s))


def has(tags: Column, *names: str) -> Column:
    return F.arrays_overlap(tags, F.array(*map(F.lit, names)))


def labelled(text: Column) -> Column:
    """array of struct(key, value) of the `key: value` lines of a text, in order."""
    lines = F.filter(F.split(text_of(text), "\n"), lambda x: F.contains(x, F.lit(":")))

    def parsed(x: Column) -> Column:
        bare = F.trim(x)
        return F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.substring(bare, F.instr(bare, ":") + 1, F.length(bare))).alias("value"))

    return F.transform(lines, parsed)


def field(lines: Column, key: str) -> Column:
    """The value of the last of the labelled lines that has the key; null without one."""
    return F.get(F.reverse(F.filter(lines, lambda x: x["key"] == key)), F.lit(0))["value"]


def normalized_series(c: Column) -> Column:
    up = F.upper(normalize_whitespace(c))
    return F.when(up == "", None).when(up.rlike(r"^[A-Z]\d+$"), F.concat(F.lit("STM32"), up)).otherwise(up)


def target_series(series: Column, repo: Column) -> Column:
    """The issue's own series, else the one in the repository's name; an array of one or none."""
    named = F.regexp_extract(F.upper(text_of(repo)), SERIES, 1)
    own = normalized_series(series)
    return F.when(own.isNotNull(), F.array(own)).when(named != "", F.array(F.concat(F.lit("STM32"), named))).otherwise(F.array().cast("array<string>"))


def aliases(component: Column, board: Column, low: Column, patterns: Column, apis: Column, versions: Column, title: Column) -> Column:
    """What users may ask for instead: phrases of known symptoms, then component, board, functions, versions and title. low: the body in lower case."""
    word = lambda w: F.contains(low, F.lit(w)) & low.rlike(rf"\b{w}\b")
    spi = F.exists(apis, lambda a: a.startswith("HAL_SPI")) & has(patterns, "dma_path")
    stuck = has(patterns, "state_stuck_busy", "callback_not_reached")
    sizes = F.when(F.contains(low, F.lit("byte")), F.slice(F.regexp_extract_all(low, F.lit(r"\b(\d{1,4})\s*bytes?\b"), F.lit(1)), 1, 3)).otherwise(F.array().cast("array<string>"))
    named = component != ""
    plain = F.concat(
        some(named, F.concat(component, F.lit(" issue"))), some(named & has(patterns, "compile_error"), F.concat(component, F.lit(" compile error"))),
        some(named & has(patterns, "timeout"), F.concat(component, F.lit(" timeout"))), some(named & has(patterns, "dma_path"), F.concat(component, F.lit(" DMA issue"))),
        some(named & (board != ""), F.concat(board, F.lit(" "), component)), F.flatten(F.transform(F.slice(apis, 1, 4), lambda a: F.array(a, F.concat(a, F.lit(" issue"))))),
        F.transform(F.slice(versions, 1, 3), lambda v: F.concat(F.lit("version regression "), v)), some(None, lead(title, 120)),
    )
    return few(
        F.concat(
            some(spi, "HAL_SPI_Transmit_DMA", "SPI DMA transfer"), some(spi & stuck, *BLOCKING_ALIASES), some(stuck & (has(patterns, "dma_path") | spi), *STUCK_ALIASES),
            some(word("small") & word("transfer"), "small transfer"), some(word("tiny") & word("transfer"), "tiny transfer"),
            F.transform(sizes, lambda n: F.concat(n, F.lit(" bytes"))), few(plain, 12),
            F.when(has(patterns, "version_regression"), F.transform(F.slice(versions, 1, 2), lambda v: F.concat(F.lit("upgrade issue "), v))).otherwise(F.array().cast("array<string>")),
        ),
        16,
    )


def checks(component: Column, case: Column, patterns: Column) -> Column:
    first_path = F.get(case["linked_file_paths"], F.lit(0))
    return few(
        F.concat(
            some(has(patterns, "callback_not_reached", "state_stuck_busy"), *CALLBACK_CHECKS), some(has(patterns, "compile_error"), COMPILE_CHECK), some(has(patterns, "timeout"), TIMEOUT_CHECK),
            some(first_path.isNotNull(), normalize_whitespace(F.concat(F.lit("Review the linked fix path and compare your local source against "), first_path))),
            some(component != "", F.concat(F.lit("Validate the exact "), component, F.lit(" configuration on the target board and firmware package"))), some(None, MINIMAL_CHECK),
        ),
        5,
    )


def questions(component: Column, series: Column, patterns: Column, apis: Column, versions: Column) -> Column:
    first_api = F.get(apis, F.lit(0))
    return few(
        F.concat(
            some(None, PART_QUESTION), some(series != "", F.concat(F.lit("Can you confirm whether your target is "), series, F.lit(" and not a close variant?"))),
            some(F.size(versions) > 0, VERSION_QUESTION), some(component != "", F.concat(F.lit("Can you share the "), component, F.lit(" configuration and initialization sequence?"))),
            some(has(patterns, "dma_path", "cache_dma"), BUFFER_QUESTION), some(has(patterns, "interrupt_path", "callback_not_reached"), INTERRUPT_QUESTION),
            some(first_api.isNotNull(), F.concat(F.lit("Can you provide a minimal reproducer around "), first_api, F.lit(" with expected vs observed behavior?"))),
        ),
        6,
    )


def workarounds(fix: Column, candidates: Column, patterns: Column) -> Column:
    return few(F.concat(some(None, signal(fix, 220)), some(text_of(candidates) != "", BRANCH_WORKAROUND), some(has(patterns, "dma_path"), DMA_WORKAROUND), some(None, PIN_WORKAROUND)), 4)


def facts(issue: Column, case: Column, strength: Column, root_cause: Column) -> Column:
    status = text_of(case["resolution_status"])
    return few(
        F.concat(
            some(text_of(issue["github_url"]) != "", normalize_whitespace(F.concat(F.lit("Issue evidence exists in "), none_text(issue["repo"]), F.lit(" issue #"), none_text(issue["issue_number"])))), some(issue["rescue_applied"], RESCUED_FACT),
            some(strength != "", F.concat(F.lit("Issue evidence strength is rated "), strength)),
            some(status != "", normalize_whitespace(F.concat(F.lit("Resolver linkage status is "), status, F.lit(" with confidence "), F.coalesce(F.nullif(case["link_confidence"], F.lit("")), F.lit("unknown"))))),
            some(F.size(case["linked_commit_shas"]) > 0, LINKED_FACT), some(case["merged_pr_with_file_evidence"], MERGED_FACT), some(None, signal(root_cause, 180)),
        ),
        4,
    )


def limits(issue: Column, case: Column, constraint: Column) -> Column:
    return few(F.concat(some(None, first_sentence(constraint, 220)), some(issue["rescue_applied"], RESCUED_CONSTRAINT), some(case["link_confidence"].isin("low", "medium"), WEAK_CONSTRAINT), some(None, LAST_CONSTRAINT)), 4)


def diagnosis(named: Sequence[Column], case: Column, patterns: Column) -> Column:
    """named: layer, component and kind of the issue."""
    traits = F.concat_ws(", ", *(F.nullif(x, F.lit("")) for x in named))
    status = text_of(case["resolution_status"])
    found = F.concat(
        some(traits != "", F.concat(F.lit("Observed behavior aligns with "), traits, F.lit(" issue characteristics"))),
        some(status.isin(*(s for s, _ in DIAGNOSES)), ordered_case([(status == s, text) for s, text in DIAGNOSES], "")),
        some(has(patterns, "version_regression"), VERSION_DIAGNOSIS), some(has(patterns, "blocking_behavior", "state_stuck_busy"), BLOCKED_DIAGNOSIS),
    )
    return or_else(few(found, 12), NO_DIAGNOSIS)


def causes(root_cause: Column, assessment: Column, told: Column) -> Column:
    return or_else(few(F.array(*(signal(c, 220) for c in (root_cause, assessment, told))), 12), NO_CAUSE)


def evidence(issue: Column, case: Column) -> Column:
    """array of struct(type, id, url, confidence), at most 6: the issue, then requests, then commits."""
    kind = "array<struct<type:string,id:bigint,url:string,confidence:string>>"
    ref = lambda name, number, url, confidence: F.struct(F.lit(name).alias("type"), number.cast("long").alias("id"), url.alias("url"), confidence.alias("confidence"))
    own = F.when(text_of(issue["github_url"]) != "", F.array(ref("issue", issue["issue_number"], issue["github_url"], issue["evidence_strength"]))).otherwise(F.array().cast(kind))

    def linked(name: str, urls: Column) -> Column:
        return F.coalesce(F.transform(urls, lambda u: ref(name, F.lit(None), u, case["link_confidence"])), F.array().cast(kind))

    others = (linked("pull_request", case["linked_pr_urls"]), linked("commit", case["linked_commit_urls"]))
    return F.slice(F.concat(own, *others), 1, 6)


def keywords(issue: Column, case: Column, told: Column, named: Sequence[Column], apis: Column, patterns: Column, versions: Column) -> Column:
    """named: component, layer, kind, severity and board of the issue."""
    none = F.array().cast("array<string>")
    traits = F.filter(F.array(*named), lambda v: ~F.lower(v).isin(*MISSING_WORDS))
    own = [F.coalesce(x, none) for x in (F.when(issue.isNotNull(), split_items(told)), issue["labels"])]
    linked = [F.coalesce(x, none) for x in (case["impacted_modules"], case["impacted_components"], F.array(text_of(case["resolution_status"])))]
    return few(F.concat(tidy(F.concat(*own)), traits, tidy(F.concat(*linked)), patterns, versions, apis), 14)


#: The lines of a card's text: label and the field that it shows.
LINES = (
    ("Facts confirmed", "confirmed_facts"), ("Hypotheses", "hypotheses"), ("Checks", "debug_checks"), ("Clarification questions (required)", "clarification_questions"), ("Likely causes", "likely_causes"),
    ("Confirmed facts", "confirmed_facts"), ("Plausible diagnosis", "plausible_diagnosis"), ("Debug actions", "debug_checks"), ("Workaround", "possible_workarounds"), ("Constraints", "constraints_or_limits"),
)


def card_text() -> Column:
    """The seventeen lines of a card, from the columns that `cards` makes."""
    bar = lambda c: F.array_join(c, " | ")
    urls = F.filter(F.transform("evidence_refs", lambda r: r["url"]), lambda u: text_of(u) != "")
    series = F.array_join("target_series", ", ")
    head = [
        F.concat(F.lit("Problem: "), none_text(F.col("title"))),
        F.concat(F.lit("Context: repo="), F.col("repo"), F.lit(", issue_number="), none_text(F.col("issue_number")), F.lit(", target_series="), F.when(series != "", series).otherwise("unknown"), F.lit(", source_types="), F.array_join("source_types", ", ")),
        F.concat(F.lit("Symptoms: "), none_text(F.col("symptom_summary"))), F.concat(F.lit("Query aliases: "), bar("query_aliases")), F.lit("Response format: facts_confirmed -> hypotheses -> checks"),
    ]
    body = [F.concat(F.lit(f"{label}: "), bar(column)) for label, column in LINES]
    tail = [F.concat(F.lit("Evidence links: "), bar(urls)), F.concat(F.lit("Keywords: "), F.array_join("keywords", " "))]
    return F.trim(F.concat_ws("\n", *head, *body, *tail))


def cards(joined: DataFrame, repo: str = "repo", issue: str = "issue", case: str = "case") -> DataFrame:
    """One diagnostic card for each row of (repo, issue struct or null, case struct or null).

    issue: repo, issue_number, issue_title, github_url, st_ready_text, component, board, layer, issue_kind, severity, mcu_series,
    evidence_strength, rescue_applied, labels. case: issue_number, issue_title, issue_url, resolver_card_text, resolution_status,
    link_confidence, linked_commit_shas, linked_pr_urls, linked_commit_urls, linked_file_paths, impacted_modules, impacted_components,
    merged_pr_with_file_evidence."""
    i, r = F.col(issue), F.col(case)
    told, solved = text_of(i["st_ready_text"]), text_of(r["resolver_card_text"])
    first = lambda *xs: F.coalesce(*(F.nullif(x, F.lit("")) for x in xs))
    parsed = joined.select(F.col(repo).alias("repo"), i.alias("issue"), r.alias("case"), labelled(told).alias("_told"), labelled(solved).alias("_solved"), technical_body(told).alias("_body"))
    base = parsed.select(
        "repo", "issue", "case", "_body", *(field(F.col("_told"), k).alias(f"_i_{n}") for n, k in (("problem", "Problem"), ("context", "Context"), ("root", "Root cause"), ("fix", "Fix"), ("constraints", "Constraints"), ("keywords", "Keywords"))),
        *(field(F.col("_solved"), k).alias(f"_r_{n}") for n, k in (("problem", "Problem"), ("context", "Context"), ("signal", "Resolver signal"), ("assessment", "Assessment"), ("candidates", "Candidate PRs"))),
    )
    i, r = F.col("issue"), F.col("case")
    told, solved = text_of(i["st_ready_text"]), text_of(r["resolver_card_text"])
    title = normalize_whitespace(F.coalesce(first(i["issue_title"], r["issue_title"], F.col("_i_problem"), F.col("_r_problem")), F.lit(UNTITLED)))
    # What several fields show is made once a row.
    names = {"component": "component", "board": "board", "layer": "layer", "kind": "issue_kind", "severity": "severity", "series": "mcu_series", "strength": "evidence_strength"}
    rows = base.select("*", title.alias("title"), F.coalesce(i["issue_number"], r["issue_number"]).alias("issue_number"), F.lower("_body").alias("_i_low"), *(normalize_whitespace(i[k]).alias(f"_i_{n}") for n, k in names.items()))
    component, board, layer, kind, severity, series, strength = (F.col(f"_i_{n}") for n in names)
    rows = rows.withColumn("api_family_tags", api_tags(F.concat_ws(" ", told, solved)))
    rows = rows.withColumn("technical_pattern_tags", failure_tags(F.concat_ws(" ", "title", text_of("_i_root"), text_of("_i_fix"), "_body", told, solved)))
    rows = rows.withColumn("version_tags", version_tags(F.concat_ws(" ", "title", "_body", text_of("_i_context"), text_of("_i_fix"), told, solved)))
    apis, patterns, versions = F.col("api_family_tags"), F.col("technical_pattern_tags"), F.col("version_tags")
    rows = rows.withColumn("query_aliases", aliases(component, board, F.col("_i_low"), patterns, apis, versions, F.col("title")))
    sentence = first(signal(F.col("_i_fix"), 220), signal(F.col("title"), 220), F.col("title"))
    leads = F.slice("query_aliases", 1, 2)
    rows = rows.withColumn("_symptom", sentence).withColumn("symptom_summary", F.when((F.size("query_aliases") > 0) & ~F.exists(leads, lambda a: F.contains(F.lower("_symptom"), F.lower(a))), F.concat("_symptom", F.lit(" ("), F.array_join(leads, ", "), F.lit(")."))).otherwise(F.col("_symptom")))
    rows = rows.select(
        "*", first_sentence(first(F.col("_i_context"), F.col("_r_context")), 220).alias("affected_context"), causes(F.col("_i_root"), F.col("_r_assessment"), F.col("_r_signal")).alias("likely_causes"),
        facts(i, r, strength, F.col("_i_root")).alias("confirmed_facts"), diagnosis((layer, component, kind), r, patterns).alias("plausible_diagnosis"), checks(component, r, patterns).alias("debug_checks"), questions(component, series, patterns, apis, versions).alias("clarification_questions"),
        workarounds(F.col("_i_fix"), F.col("_r_candidates"), patterns).alias("possible_workarounds"), limits(i, r, F.col("_i_constraints")).alias("constraints_or_limits"), evidence(i, r).alias("evidence_refs"),
        few(F.concat(F.col("query_aliases"), keywords(i, r, F.col("_i_keywords"), (component, layer, kind, severity, board), apis, patterns, versions)), 24).alias("keywords"), few(F.concat(F.col("query_aliases"), apis, patterns, versions), 24).alias("query_anchor_tags"),
        target_series(i["mcu_series"], F.col("repo")).alias("target_series"), few(some(None, component), 4).alias("peripheral_tags"),
        or_else(F.concat(some(i["rescue_applied"], "rescued_issue"), some(r.isNotNull(), "resolver_case")), "issue").alias("source_types"),
        first(i["evidence_strength"], r["link_confidence"]).alias("evidence_strength"), F.coalesce(i["rescue_applied"], F.lit(False)).alias("rescue_applied"), r["resolution_status"].alias("resolution_status"),
        F.concat(F.lit("diag::"), F.col("repo"), F.lit("::issue::"), F.coalesce(F.col("issue_number").cast("string"), slugify(F.col("title")))).alias("id"), first(i["github_url"], r["issue_url"]).alias("externalURL"),
    ).withColumn("hypotheses", or_else(few(F.concat("plausible_diagnosis", "likely_causes"), 8), NO_HYPOTHESIS))
    return rows.withColumn("st_ready_text", card_text()).drop("issue", "case", "_symptom", "_body", *(c for c in rows.columns if c.startswith(("_i_", "_r_"))))


def curated(repos: DataFrame, templates: DataFrame, repo: str = "repo") -> DataFrame:
    """Every template of general knowledge as a card of every main repository of a series that it applies to.

    templates: topic_id, applies_to (array of series; null: all), title, symptom_summary, component, doc_url and arrays named as
    in `cards`. Both sides are fixed dimensions; the cross join is bounded by them."""
    main = repos.where(F.col(repo).rlike("(?i)^stm32cube[a-z]")).select(F.col(repo).alias("repo"), F.get(target_series(F.lit(None).cast("string"), F.col(repo)), F.lit(0)).alias("series")).where("series IS NOT NULL")
    both = main.crossJoin(F.broadcast(templates)).where(F.col("applies_to").isNull() | F.array_contains("applies_to", F.col("series")))
    none = F.array().cast("array<string>")
    rows = both.select(
        F.concat(F.lit("diag::"), "repo", F.lit("::curated::"), "topic_id").alias("id"), "repo", "title", "symptom_summary", F.array("series").alias("target_series"), F.array(F.lit("curated")).alias("source_types"), F.lit(None).cast("long").alias("issue_number"),
        few(tidy(F.col("query_aliases")), 16).alias("query_aliases"), "confirmed_facts", "plausible_diagnosis", "likely_causes", "debug_checks", "possible_workarounds", "constraints_or_limits", none.alias("clarification_questions"),
        or_else(few(tidy(F.concat("plausible_diagnosis", "likely_causes")), 8), NO_HYPOTHESIS).alias("hypotheses"), few(F.concat(few(tidy(F.col("query_aliases")), 16), tidy(F.col("keywords"))), 24).alias("keywords"),
        F.array(F.struct(F.lit("documentation").alias("type"), F.col("doc_url").alias("url"), F.lit("high").alias("confidence"))).alias("evidence_refs"),
    )
    return rows.withColumn("st_ready_text", card_text())
