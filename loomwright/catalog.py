"""All queries of the engine's own operators with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules with QUERIES and ORACLE_SQL, in the order of the survey's families.
MODULES: tuple[str, ...] = ("loomwright.plans.linking", "loomwright.plans.cleaning", "loomwright.plans.ranking", "loomwright.plans.retrieval", "loomwright.plans.cards", "loomwright.plans.tagging", "loomwright.plans.support", "loomwright.plans.delivery", "loomwright.plans.repair", "loomwright.plans.cases")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to callable(spark, sf_dir)."""
    found: dict = {}
    for name in MODULES:
        found |= import_module(name).QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL over the same tables."""
    found: dict = {}
    for name in MODULES:
        found |= import_module(name).ORACLE_SQL
    return found


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query."""
    return queries()["link_status"](spark, sf_dir)
