"""How five filters interact: a direct relational replay of all 120 orders.

Each document's failed filters are five bits. The rows cross a broadcast table of the 120 orders, give
their first failure in each, explode into five steps and are summed by part, order and step with
map-side combining, so a shuffle holds at most 600 rows a part from each task.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .support import SPACE, documents, whole_text, written

LETTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
ORDERS = tuple("".join(p) for p in permutations(LETTERS))

#: The counted columns, in the order of the result.
COUNTED = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


@dataclass(frozen=True)
class Limits:
    """least_words: A. distinct_share: B, in hundredths of the words. capital_share: C, in hundredths of the code points. marks: D, a character class."""

    least_words: int = 50
    distinct_share: int = 65
    capital_share: int = 5
    marks: str = "[#$%&*|]"


def text_flags(text: Column, limits: Limits = Limits()) -> Column:
    """The bits of the filters A to D that a text fails; null counts as empty."""
    text = whole_text(text)
    words = F.array_remove(F.split(text, SPACE), "")
    failed = {
        "A": F.size(words) < limits.least_words,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * limits.distinct_share,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * limits.capital_share,
        "D": text.rlike(limits.marks),
    }
    return sum((F.when(f, BIT[letter]).otherwise(0) for letter, f in failed.items()), F.lit(0))


def flagged(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, part, flags) for each row of docs, E included.

    E asks for an equal text (by its SHA-256) at a smaller id anywhere in the table. A null id is neither smaller
    nor larger than another; rows that share an id do not fail through each other. Texts are read once; what
    is joined is narrow, and only hashes of several rows are joined, so AQE can split a hot one.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(whole_text(text_col), 256)).alias("h"), text_flags(F.col(text_col), limits).alias("flags"))
    narrow = written(narrow, "flags")
    groups = narrow.groupBy("h").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "least")
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return narrow.join(groups, "h", "left").select("id", "part", F.when(copy, F.col("flags") + BIT["E"]).otherwise(F.col("flags")).alias("flags"))


def orders_table(spark: SparkSession) -> DataFrame:
    """The 120 orders: a number and the five bits in the order of their steps."""
    rows = [(i, *(BIT[letter] for letter in order)) for i, order in enumerate(ORDERS)]
    return spark.createDataFrame(rows, "place int, bit1 int, bit2 int, bit3 int, bit4 int, bit5 int")


def replay(flags: DataFrame) -> DataFrame:
    """(part, flags, good, toxic) rows to (part, filter_order, step, counts, shapley), 600 rows a part, zeros included."""
    bits = [F.col(f"bit{s}") for s in range(1, 6)]
    # 120 rows, whatever the corpus.
    crossed = flags.crossJoin(F.broadcast(orders_table(flags.sparkSession)))
    first = F.coalesce(F.least(*(F.when(F.col("flags").bitwiseAND(b) != 0, s) for s, b in enumerate(bits, 1))), F.lit(6))
    steps = F.explode(F.array(*(F.struct(F.lit(s).alias("step"), b.alias("bit")) for s, b in enumerate(bits, 1))))
    replayed = crossed.select("part", "flags", "good", "toxic", "place", first.alias("first"), steps.alias("at")).select("*", "at.step", "at.bit")
    here, fails = F.col("first") == F.col("step"), F.col("flags").bitwiseAND(F.col("bit")) != 0
    cases = (F.col("first") > F.col("step"), here, fails & (F.col("first") < F.col("step")), F.col("flags") == F.col("bit"), here & F.col("good"), here & F.col("toxic"))
    counts = replayed.groupBy("part", "place", "step").agg(*(F.count_if(c).alias(name) for name, c in zip(COUNTED, cases, strict=True)))
    named = counts.withColumn("filter_order", F.element_at(F.array(*map(F.lit, ORDERS)), F.col("place") + 1))
    # 120 rows for each part and filter.
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    shapley = F.sum("removed").over(Window.partitionBy("part", letter))
    return named.select("part", "filter_order", "step", *COUNTED, shapley.alias("shapley"))


def interaction_audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", label_id: str = "doc_id") -> DataFrame:
    """One row for each part, order of the five filters and step, counting documents of the part.

    Null texts are empty, null sources the part with the empty name. A document is good (toxic) where any of its
    label rows says 1; label rows without an id, and documents without one, meet nothing. Repeated rows of docs are
    counted each. Other columns are not read and may have any name. An empty table gives no rows.
    """
    marked = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("id")).agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))
    flags = flagged(docs, limits, id_col, text_col, source_col).join(marked, "id", "left")
    return replay(flags.select("part", "flags", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT t.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(CASE WHEN len(words) < 50 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END,
      CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM t LEFT JOIN l ON t.doc_id = l.doc_id
), p AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || letter FROM p, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS x(letter) WHERE NOT contains(filter_order, letter)
), r AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
    contains(fails, substr(filter_order, step, 1)) AS failing,
    regexp_matches(fails, '[' || substr(filter_order || '-', 1, greatest(step - 1, 0)) || '-]') AS earlier,
    fails, good, toxic
  FROM d, (SELECT filter_order FROM p WHERE length(filter_order) = 5), (VALUES (1), (2), (3), (4), (5)) AS s(step)
), g AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter, count(*) FILTER (WHERE NOT failing AND NOT earlier) AS kept, count(*) FILTER (WHERE failing AND NOT earlier) AS removed,
    count(*) FILTER (WHERE failing AND earlier) AS redundant, count(*) FILTER (WHERE fails = letter) AS unique_fails,
    count(*) FILTER (WHERE failing AND NOT earlier AND good = 1) AS good_lost, count(*) FILTER (WHERE failing AND NOT earlier AND toxic = 1) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM g
"""
