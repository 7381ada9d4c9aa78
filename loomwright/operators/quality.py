"""Coverage, gates, strategy scores and data contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.rules import ordered_case, text_of

# Weights of the strategy score.
TOP1, TOP3, ANSWER, HALLUCINATION, LATENCY = 0.40, 0.20, 0.35, -0.15, -0.05


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """100 * part / whole, 0 where there is nothing, as a decimal so that ties round the same everywhere."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.floor(part * (100 * 10**places) / whole + 0.5) / 10**places)


def strategy_scores(rows: DataFrame, strategy: str, top1: str, top3: str, answer: str, hallucination: str, latency: str) -> DataFrame:
    """Means of four flags and of the latency for each strategy, and the weighted score with the latency scaled between the global extremes."""
    means = rows.groupBy(strategy).agg(*(F.avg(c).alias(a) for c, a in ((top1, "top1"), (top3, "top3"), (answer, "answer"), (hallucination, "hallucination"), (latency, "latency"))))
    spread = rows.agg(F.min(latency).alias("_lo"), F.max(latency).alias("_hi"))  # one row
    scaled = means.crossJoin(spread).withColumn("latency_norm", (F.col("latency") - F.col("_lo")) / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-9)))
    score = TOP1 * F.col("top1") + TOP3 * F.col("top3") + ANSWER * F.col("answer") + HALLUCINATION * F.col("hallucination") + LATENCY * F.col("latency_norm")
    return scaled.withColumn("score", score).drop("_lo", "_hi")


def scoped(df: DataFrame, group: str, measures: Mapping[str, Column], everything: str = "global") -> DataFrame:
    """Measures for each group and for all rows, in one pass over grouping sets."""
    out = df.groupingSets([[group], []], group).agg(F.grouping(group).alias("_all"), *(m.alias(n) for n, m in measures.items()))
    return out.withColumn("scope", F.when(F.col("_all") == 1, F.lit(everything)).otherwise(F.col(group).cast("string"))).drop("_all", group)


def violations(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """(table, rule, violations, rows): each rule holds for a row or counts, in one aggregate. A rule that is null counts too."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()))
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules)))
    return counted.select(F.lit(table).alias("table_name"), "rows", pairs.alias("_p")).select("table_name", "_p.rule", "_p.violations", "rows")


def missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of left whose key is nowhere in right."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# The patterns of noise lines, in the order that decides.
BIT_MACRO = r"^#define\s+\w+_(Pos|Msk|\d+)\b"
LEGAL = r"(?i)(copyright|all rights reserved|licensed under|spdx|permission is hereby)"
BADGE_OR_IMAGE = r"!\[[^\]]*\]\([^)]+\)"
BANNER = r"^[\s/*#_=\-]{12,}$"


def noise_reason(line: Column) -> Column:
    """Why a line is noise: empty, macro of register bits, legal, image or badge, markup, banner; null for signal."""
    s = F.regexp_replace(text_of(line), r"^\s+|\s+$", "")
    plain = F.regexp_replace(F.regexp_replace(s, "<[^>]+>", ""), r"^\s+|\s+$", "")
    return ordered_case(
        [
            (s == "", "empty"), (s.rlike(BIT_MACRO), "cmsis_bit_macro"), (s.rlike(LEGAL), "license_or_legal"), (s.rlike(BADGE_OR_IMAGE), "markdown_image_or_badge"),
            (s.rlike("<[^>]+>") & (F.length(plain) <= F.greatest(F.lit(8), F.floor(F.length(s) / 4))), "html_structure"), (s.rlike(BANNER), "ascii_banner"),
        ],
        None,
    )


def signal_density(docs: DataFrame, text_col: str, group: str) -> DataFrame:
    """Characters and lines, all and of signal, with their shares, for each group and for all (scope `all`). Empty lines do not count."""
    lines = docs.select(F.coalesce(F.col(group), F.lit("other")).alias("_g"), F.explode(F.split(text_of(text_col), "\r\n|\n|\r")).alias("_l"))
    kept = lines.withColumn("_l", F.regexp_replace("_l", r"^\s+|\s+$", "")).where("_l <> ''").withColumn("_signal", noise_reason(F.col("_l")).isNull())
    n = F.length("_l")
    sums = kept.groupingSets([["_g"], []], "_g").agg(
        F.grouping("_g").alias("_all"), F.sum(n).alias("total_chars"), F.sum(F.when(F.col("_signal"), n).otherwise(0)).alias("signal_chars"), F.count(F.lit(1)).alias("total_lines"), F.count_if("_signal").alias("signal_lines")
    )
    scope = F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("_g"))
    return sums.select(scope.alias("scope"), "total_chars", "signal_chars", "total_lines", "signal_lines", F.round(F.col("signal_chars") / F.col("total_chars"), 6).alias("density_chars"), F.round(F.col("signal_lines") / F.col("total_lines"), 6).alias("density_lines"))


def density_gain(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per scope the density of characters of two cleanings and the gain in percent of the first; one row for each scope."""
    old, new = before.select("scope", F.col("density_chars").alias("before")), after.select("scope", F.col("density_chars").alias("after"))
    return old.join(new, "scope").select("scope", "before", "after", F.when(F.col("before") > 0, F.bround((F.col("after") - F.col("before")) / F.col("before") * 100, 2)).otherwise(0.0).alias("gain_pct"))


def value_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most common values, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def json_rows(df: DataFrame, raw: str, schema: str, rules: Mapping[str, Column], key: str) -> DataFrame:
    """(key, status): ok, missing (no text, or no JSON) or invalid (a rule does not hold) for each text that should hold one object."""
    parsed = df.select(F.col(key), F.try_parse_json(F.col(raw)).alias("_v"), F.from_json(F.col(raw), schema).alias("_r")).select(key, "_v", "_r.*")
    holds = F.lit(True)
    for rule in rules.values():
        holds = holds & F.coalesce(rule, F.lit(False))
    return parsed.select(key, F.when(F.col("_v").isNull(), "missing").when(holds, "ok").otherwise("invalid").alias("status"))


def coherence_summary(rows: DataFrame, source: str = "source", low: str = "flag_low_coherence", score: str = "coherence_score", band: str = "reliability_class") -> DataFrame:
    """For each source: rows, low ones and their rate, mean score, and how many rows each class has."""
    classes = [F.count_if(F.col(band) == c).alias(c) for c in ("EXCELLENT", "BON", "ACCEPTABLE", "INSUFFISANT")]
    n = F.count(F.lit(1))
    return rows.groupBy(F.col(source).alias("source")).agg(n.alias("n"), F.sum(low).cast("long").alias("low_coherence"), F.bround(F.sum(low) / n, 4).alias("low_rate"), F.bround(F.avg(score), 4).alias("avg_score"), *classes)
