"""Texts into chunks of bounded length, by paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.rules import text_of
from loomwright.functions.text import strip


def paragraphs(text: Column, most: int, separator: str = "\n\n", in_text_order: bool = False) -> Column:
    """Paragraphs packed greedily into chunks of at most `most` characters; longer ones are cut hard.

    As the reference orders them, slices of a long paragraph come before the chunk that was open; with in_text_order
    the open chunk is closed first."""
    parts = F.filter(F.transform(F.split(text_of(text), separator), strip), lambda p: p != "")
    empty = F.array().cast("array<string>")
    gap = len(separator)

    def step(acc: Column, p: Column) -> Column:
        whole = F.floor((F.length(p) - 1) / most).cast("int")
        slices = F.when(whole > 0, F.transform(F.sequence(F.lit(0), F.greatest(whole - 1, F.lit(0))), lambda i: F.substring(p, i * most + 1, F.lit(most)))).otherwise(empty)
        rest = F.substring(p, whole * most + 1, F.lit(most))
        if in_text_order:
            flushed = F.when((whole > 0) & (acc["cur"] != ""), F.array_append(acc["out"], acc["cur"])).otherwise(acc["out"])
            out, cur = F.concat(flushed, slices), F.when(whole > 0, F.lit("")).otherwise(acc["cur"])
        else:
            out, cur = F.concat(acc["out"], slices), acc["cur"]
        fits = F.length(cur) + F.length(rest) + gap <= most
        return F.struct(
            F.when(fits | (cur == ""), out).otherwise(F.array_append(out, cur)).alias("out"),
            F.when(cur == "", rest).when(fits, F.concat(cur, F.lit(separator), rest)).otherwise(rest).alias("cur"),
        )

    return F.aggregate(parts, F.struct(empty.alias("out"), F.lit("").alias("cur")), step, lambda acc: F.when(acc["cur"] == "", acc["out"]).otherwise(F.array_append(acc["out"], acc["cur"])))


def chunks(docs: DataFrame, id_col: str, text_col: str, most: int, separator: str = "\n\n") -> DataFrame:
    """Rows (id, chunk_index, chunk_count, chunk_id, chunk); a text without paragraphs is one chunk, itself."""
    packed = docs.select(F.col(id_col), paragraphs(F.col(text_col), most, separator).alias("_c"), text_of(text_col).alias("_t"))
    packed = packed.withColumn("_c", F.when(F.size("_c") == 0, F.array("_t")).otherwise(F.col("_c")))
    return packed.select(id_col, F.size("_c").alias("chunk_count"), F.posexplode("_c").alias("chunk_index", "chunk")).withColumn("chunk_id", F.concat_ws("-", id_col, "chunk_index"))
