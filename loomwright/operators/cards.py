"""Cards: nested records with a rendered text, and template tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def none_text(c: Column) -> Column:
    """A value as the reference's templates print it: None for null."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def flag_text(c: Column) -> Column:
    """A boolean as True, False or None."""
    return none_text(F.initcap(c.cast("string")))


def lines(*parts: tuple[str, Column]) -> Column:
    """`label: value` lines; lines whose value is null are left out."""
    return F.concat_ws("\n", *(F.concat(F.lit(f"{label}: "), value.cast("string")) for label, value in parts))


def bullets(text: Column, most: int = 12) -> Column:
    """The first lines of a text as a list."""
    kept = F.slice(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1, most)
    return F.array_join(F.transform(kept, lambda x: F.concat(F.lit("- "), x)), "\n")


def evidence_refs(groups: Sequence[tuple[str, Column]], most: int = 6) -> Column:
    """array of struct(type, id) from arrays of ids, in the order of the groups, at most so many."""
    return F.slice(F.concat(*(_refs(kind, ids) for kind, ids in groups)), 1, most)


def _refs(kind: str, ids: Column) -> Column:
    return F.transform(ids, lambda x: F.struct(F.lit(kind).alias("type"), x.cast("string").alias("id")))


def from_templates(templates: DataFrame, values: DataFrame, text_col: str, slots: dict[str, str]) -> DataFrame:
    """Every template with every row of a small dimension, its slots filled. Both sides are fixed dimensions."""
    out = templates.crossJoin(values)
    filled = F.col(text_col)
    for slot, column in slots.items():
        filled = F.replace(filled, F.lit("{" + slot + "}"), F.col(column))
    return out.withColumn(text_col, filled)


def merged(issues: DataFrame, cases: DataFrame, key: str) -> DataFrame:
    """Issue cards and resolver cases on their key; either side may be missing."""
    return issues.join(cases, key, "full_outer")


def card_issues(issues: DataFrame, include_all: bool = False, number: str = "issue_number", rescued: str = "rescue_applied") -> DataFrame:
    """Issues that get a diagnostic card: rescued ones, or all on demand; never one without a number. A missing mark counts as not rescued."""
    numbered = issues.where(F.col(number).isNotNull())
    return numbered if include_all else numbered.where(F.coalesce(F.col(rescued), F.lit(False)))
