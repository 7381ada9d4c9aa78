"""Answers of a chat service: their text and sources, checks of them, strategies, and data sources by name."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwright.functions.rules import text_of
from loomwright.operators.windows import ordered_distinct, prefer

# Keys of an answer's text and of a source, in the order of preference; lists that hold sources; words of a gone entry.
ANSWER_KEYS = ("text", "content", "message", "answer", "final")
SOURCE_LISTS = ("sources", "documents", "citations", "evidence", "context")
SOURCE_KEYS = ("title", "name", "url", "externalURL", "repo", "path", "id", "label")
CONTEXT_KEYS = ("body", "clean_text", "text", "description", "resolver_card_text", "st_ready_text")
SCORE_COLUMNS = ("quality_index_score_0_to_100", "score_0_to_100", "score")
GONE = ("deleted", "inactive", "archived", "removed")


def _string(v: Column, path: str) -> Column:
    """A string at a path of a variant, trimmed; null for other kinds and for blanks."""
    at = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", F.nullif(F.trim(F.try_variant_get(v, path, "string")), F.lit("")))


def answer_text(raw: Column) -> Column:
    """The answer in a JSON response: `completion`, else other keys in their order, else the first choice; empty where there is none."""
    v = F.try_parse_json(raw)
    first = [_string(v, "$.completion"), *(_string(v, f"$.{k}") for k in ANSWER_KEYS), _string(v, "$.choices[0].message.content"), *(_string(v, f"$.choices[0].{k}") for k in ("text", "content"))]
    return F.coalesce(*first, F.lit(""))


def cited(node) -> list[str]:
    """What a parsed response cites, each once, in the order of the document: items of lists under a key of SOURCE_LISTS, in any case and at any depth."""
    found: dict[str, None] = {}
    open_ = [node]
    while open_:
        node = open_.pop()
        if isinstance(node, list):
            open_.extend(reversed(node))
        elif isinstance(node, tuple):
            for item in node[0]:
                told = " | ".join(str(item[k]) for k in SOURCE_KEYS if item.get(k) is not None) if isinstance(item, dict) else item if isinstance(item, str) else ""
                if told.strip():
                    found.setdefault(told.strip())
            open_.append(node[0])
        elif isinstance(node, dict):
            open_.extend((v,) if k.lower() in SOURCE_LISTS and isinstance(v, list) else v for k, v in reversed(node.items()))
    return list(found)


@F.pandas_udf(T.ArrayType(T.StringType()))
def answer_sources(raw: pd.Series) -> pd.Series:
    """What JSON responses cite, each once: lists of sources at any depth, an object's fields joined by ` | `; none where a text is no JSON.

    A walk in the order of the document, which a variant does not keep, so it runs in Arrow batches."""
    import json

    def sources(text) -> list[str]:
        try:
            return cited(json.loads(text)) if text else []
        except ValueError:
            return []

    return raw.map(sources, na_action=None)


def context_field(columns: list[str]) -> Column:
    """struct(field, text) of the first of the known fields that is there and not blank; raw fields come before enriched ones."""
    from loomwright.functions.text import clean_context, strip

    some = [F.when(strip(text_of(k)) != "", F.struct(F.lit(k).alias("field"), clean_context(F.col(k)).alias("text"))) for k in CONTEXT_KEYS if k in columns]
    return F.coalesce(*some, F.struct(F.lit("").alias("field"), F.lit("").alias("text")))


def forbidden_found(answer: Column, pattern: str | None) -> Column:
    """1 or 0: whether a pattern that a right answer does not have is found; empty where none is given or it is no pattern.

    The pattern is one of a question set, so it is a constant of its rows."""
    import re

    given = (pattern or "").strip()
    try:
        re.compile(given)
    except re.error:
        given = ""
    return F.lit("") if not given else text_of(answer).rlike("(?i)" + given).cast("int").cast("string")


@F.pandas_udf(T.StringType())
def forbidden_flags(answer: pd.Series, pattern: pd.Series) -> pd.Series:
    """forbidden_found of pairs: a pattern is compiled once in a batch, whatever their number."""
    import re
    from functools import lru_cache

    @lru_cache(maxsize=4096)
    def compiled(given: str):
        try:
            return re.compile(given, re.IGNORECASE) if given else None
        except re.error:
            return None

    def flag(text, given) -> str:
        found = compiled((given or "").strip())
        return "" if found is None else str(int(bool(found.search(text or ""))))

    return pd.Series([flag(*pair) for pair in zip(answer, pattern, strict=True)], dtype=object)


def forbidden_by_question(answers: DataFrame, questions: DataFrame, key: str, answer: str, pattern: str, out: str = "hallucination") -> DataFrame:
    """forbidden_found for every answer with its question's pattern; questions may be any number."""
    both = answers.join(questions.select(key, F.col(pattern).alias("_p")), key, "left")
    return both.withColumn(out, forbidden_flags(F.col(answer), F.col("_p"))).drop("_p")


def is_evaluated(columns: tuple[str, ...] = ("has_relevant_doc_top1", "has_relevant_doc_top3", "final_answer_correct", "hallucination", "latency_seconds")) -> Column:
    """Whether all fields of a run's row are filled in."""
    return F.forall(F.array(*(text_of(F.col(c).cast("string")) for c in columns)), lambda x: F.trim(x) != "")


def of_run(rows: DataFrame, run_id: str = "", strategy: str = "") -> DataFrame:
    """Rows of one run and of one strategy, where these are given."""
    for column, value in (("run_id", run_id), ("strategy_id", strategy)):
        rows = rows.where(F.trim(text_of(column)) == value) if value else rows
    return rows


def best_first(scores: DataFrame, strategy: str = "strategy", score: str = "score") -> DataFrame:
    """Strategies by score, best first, ties by name; there are few."""
    return scores.orderBy(F.desc(score), strategy)


def scope_order(scope: Column) -> Column:
    """Where a scope stands in a report: global, issues, files, mixed, then others."""
    return F.when(scope == "global", 0).when(scope == "issues", 1).when(scope == "files", 2).when(scope == "mixed", 3).otherwise(99)


def question_order(question_id: Column) -> Column:
    """The number in a question's id, 9999 without one."""
    return F.coalesce(F.regexp_extract(text_of(question_id), r"(\d+)", 1).try_cast("long"), F.lit(9999))


def strategy_matrix(rows: DataFrame, key: str = "strategy_id") -> DataFrame:
    """Named strategies; of rows with one name the last, rows without a name are left out."""
    named = rows.withColumn("_key", F.trim(text_of(key))).where("_key <> ''").withColumn("_at", F.monotonically_increasing_id())
    return prefer(named, ["_key"], [F.desc("_at")]).withColumn(key, F.col("_key")).drop("_key", "_at")


def online_scores(rows: DataFrame) -> DataFrame:
    """Rows with a column online_score_0_to_100 from the first score column that the table has, whatever its case; null without one."""
    named = {c.lower(): c for c in rows.columns}
    column = next((named[c] for c in SCORE_COLUMNS if c in named), None)
    return rows.withColumn("online_score_0_to_100", F.trim(F.col(column).cast("string")).try_cast("double") if column else F.lit(None).cast("double"))


def is_gone(entry: Column) -> Column:
    """Whether a data source's entry (JSON) says that it is deleted, by any of the spellings that occur."""
    v = F.try_parse_json(entry)
    flag = lambda k: F.lower(F.trim(F.try_variant_get(v, f"$.{k}", "string")))
    kind = lambda k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant"))
    out = F.when(F.lit(False), F.lit(False))
    for k in ("deleted", "isDeleted", "is_deleted"):
        out = out.when(kind(k) == "BOOLEAN", flag(k) == "true").when(flag(k).isin("1", "true", "yes", "y") | (F.abs(F.try_variant_get(v, f"$.{k}", "double")) >= 1), True)
    status = F.coalesce(F.nullif(flag("status"), F.lit("")), flag("state"))
    dated = text_of(F.coalesce(F.nullif(flag("deletedAt"), F.lit("")), flag("deleted_at"))) != ""
    return F.coalesce(out.when(dated, True).when(status.isin(*GONE), True).when(kind("active") == "BOOLEAN", flag("active") == "false"), F.lit(False))


def source_ids(entries: DataFrame, wanted: DataFrame, name: str = "name", entry_id: str = "id") -> DataFrame:
    """(wanted, id): data sources of each wanted name, equal but for case, or below the prefix of a canonical name `DB_STready_<series>_<kind>`."""
    canonical = F.regexp_extract(F.trim(F.col("wanted")), r"(?i)^(DB_STready_[A-Za-z0-9]+_(Issues|Files|Diagnostic|Resolver))$", 1)
    # One key for the whole name and one for the prefix, so the join is on equality.
    keys = wanted.select("wanted", F.explode(F.array_compact(F.array(F.lower(F.trim("wanted")), F.when(canonical != "", F.concat(F.lower(canonical), F.lit("_")))))).alias("k"))
    low = F.lower(F.col(name))
    prefix = F.regexp_extract(low, "^(db_stready_[a-z0-9]+_(issues|files|diagnostic|resolver)_)", 1)
    offered = entries.select(F.col(entry_id).alias("id"), F.explode(F.array_distinct(F.array_compact(F.array(low, F.nullif(prefix, F.lit("")))))).alias("k"))
    return keys.join(offered, "k").select("wanted", "id").distinct()


def preferred_source(entries: DataFrame, keys: list[str], raw: str = "raw", entry_id: str = "id") -> DataFrame:
    """Of a name's entries the one with the largest id that is not gone, else the one with the largest id."""
    return prefer(entries.withColumn("_gone", is_gone(F.col(raw))), keys, [F.col("_gone"), F.desc(entry_id)]).drop("_gone")


def flat_run(rows: DataFrame) -> DataFrame:
    """A run's rows as its flat table has them; sources are an array, kept in its first and its first three entries."""
    sources = F.coalesce("sources", F.array().cast("array<string>"))
    return rows.select(
        text_of("query_id").alias("query_id"), text_of("query_text").alias("query_text"), F.format_string("%.3f", F.coalesce("latency_seconds", F.lit(0.0))).alias("latency_seconds"),
        F.replace(text_of("answer_text"), F.lit("\n"), F.lit(" ")).alias("answer_text"), text_of(F.get(sources, F.lit(0))).alias("sources_top1"), F.array_join(F.slice(sources, 1, 3), " || ").alias("sources_top3"), text_of("error").alias("error"),
    )


def described(tasks: DataFrame, key: str = "image_id", order: Sequence[str] = ()) -> DataFrame:
    """Task rows by image, the last of an image in this order (without one, as they are read); rows without an image are left out."""
    named = tasks.where(text_of(F.col(key).cast("string")) != "")
    if order:
        return prefer(named, [key], [F.desc(c) for c in order])
    return prefer(named.withColumn("_at", F.monotonically_increasing_id()), [key], [F.desc("_at")]).drop("_at")


def sources_of_text(text: Column) -> Column:
    """Citations in an ordered list, each once whatever its case."""
    return ordered_distinct(F.filter(F.transform(F.split(text_of(text), r" \|\| "), F.trim), lambda x: x != ""))
