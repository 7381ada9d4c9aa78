"""Exact duplicates: 128-bit content hash, byte comparison inside the hash groups, smallest stable id.

Native: DataFrame functions only. Plan: one shuffle of the texts, keyed by (hash, bytes) and combined
on the map side, so a text that fills a third of the rows travels once per map task; then a join of
narrow rows (ids and hashes) that AQE can split at a hot hash. Where a hash has one text, as a group-by
of the bytes has shown, its rows have that text; only rows of a hash with several texts meet them again
byte by byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import SPACE, documents, durable, whole_text


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text))


def normalised(text: str | Column = "text") -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(whole_text(text), SPACE, "")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """One row per row of docs: its id, keep_id, group_size, kept and text_sha256.

    Texts are equal when their bytes are, after white space is deleted; a hash that different texts
    share gives as many groups as texts. The row with the most code points in the original text stays,
    then the smallest id (null ids last; ids of any type that has an order). Null and empty texts are one
    group. Rows that repeat the kept id with the same text are all marked kept. Only id and text are read,
    so other columns may have any name. An empty table gives no rows.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.length(whole_text(text_col)).alias("n"), normalised(text_col).alias("norm")).withColumn("h", hash_of(F.col("norm")))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("none"), F.col("id").alias("id")))

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))

    found = grouped(keyed).select("h", F.sha2("norm", 256).alias("text_sha256"), "group_size", F.col("best.id").alias("keep_id"))
    narrow = found.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), *(F.first(c).alias(c) for c in ("text_sha256", "group_size", "keep_id")))
    narrow = durable(narrow)
    out = keyed.select("id", "h").join(narrow.where("texts = 1"), "h")
    clashing = narrow.where("texts > 1").select("h")
    if clashing.limit(1).count():
        again = keyed.join(clashing, "h", "left_semi")
        apart = grouped(again).select("h", "norm", F.sha2("norm", 256).alias("text_sha256"), "group_size", F.col("best.id").alias("keep_id"))
        out = out.select("id", "text_sha256", "group_size", "keep_id").unionByName(again.join(apart, ["h", "norm"]).select("id", "text_sha256", "group_size", "keep_id"))
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """docs without the rows that decisions() drops; repeated rows of a kept id leave one row. Columns may have any name."""
    kept = decisions(docs, id_col, text_col, hash_of).where("kept").groupBy(F.col(id_col).alias("id"), "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    kept = durable(kept)
    # Whole rows are dealt out once, by id and text; only where an id is repeated are they aggregated too.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    marked = rows.withColumn("key", F.col("row").getField(id_col)).withColumn("sha", F.sha2(normalised(F.col("row").getField(text_col)), 256))
    out = marked.join(kept, marked["key"].eqNullSafe(kept["id"]) & (marked["sha"] == kept["text_sha256"]), "left_semi")
    if kept.where("n > 1").limit(1).count():
        out = out.dropDuplicates(["key", "sha"])
    return out.select("row.*")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
