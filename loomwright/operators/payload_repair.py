"""Repair of JSON payloads whose figure descriptions were written into strings without escapes.

Texts that are no JSON are opened at their description blocks; each block's figures are looked up in the table of descriptions by a
join, the blocks are written anew with escapes, and the whole is checked again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.durable import stored
from loomwright.functions.rules import text_of
from loomwright.functions.text import json_escaped, strip

# The marks of a block, ids of figures in it (strictly, else anywhere), and what stands for a missing description.
OPEN, CLOSE = "[FIGURE_DESCRIPTIONS]", "[/FIGURE_DESCRIPTIONS]"
BLOCK = r"(?s)\[FIGURE_DESCRIPTIONS\].*?\[/FIGURE_DESCRIPTIONS\]"
FIGURE = r"-\s*([^\s:]+:[^\s:]+\.pdf:p\d+:f\d+):?\s*"
ANY_FIGURE = r"(STM32Cube\w+:[^:]+\.pdf:p\d+:f\d+)"
MISSING = "No description available."


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(…, content) to the same with status: ok, relaxed (valid but for control characters in strings; written anew) or broken."""
    for b in batches:
        status, contents = [], []
        for content in b.column(b.num_columns - 1).to_pylist():
            try:
                json.loads(content or "")
                status.append("ok")
            except ValueError:
                try:
                    content = json.dumps(json.loads(content or "", strict=False), ensure_ascii=False, indent=2)
                    status.append("relaxed")
                except ValueError:
                    status.append("broken")
            contents.append(content)
        yield pa.record_batch([*b.columns[:-1], pa.array(contents, pa.string()), pa.array(status)], [*b.schema.names, "status"])


def _with_status(rows: DataFrame, key: str) -> DataFrame:
    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "content").mapInArrow(_checked, f"`{key}` {kind}, content string, status string")


def block_lines(figure: Column, description: Column) -> Column:
    """A figure's line in a block, escaped for a JSON string."""
    told = strip(text_of(description))
    escaped = F.regexp_replace(json_escaped(told), r"[\x00-\x1f]", "")
    return F.concat(F.lit("- "), figure, F.lit(": "), F.when(told == "", MISSING).otherwise(escaped))


def repaired(files: DataFrame, descriptions: DataFrame, key: str = "path", figure: str = "figure_id", description: str = "description") -> DataFrame:
    """(key, status, content) for each of files(key, content): ok and unchanged, fixed by new blocks, relaxed (blocks anew and control characters escaped) or failed and unchanged.

    Keys are unique. A null content is empty, which is no JSON. A block without a figure's id stays as it is; a figure without a
    description gets a note; of several descriptions of a figure the last by text counts. Empty tables give no rows."""
    first = files.select(key, text_of("content").alias("content"))
    checked = stored(_with_status(first, key).select(F.col(key), "status").withColumnRenamed("status", "was"), "checked")
    broken = first.join(checked.where("was <> 'ok'").select(key), key, "left_semi")
    blocks = broken.select(key, F.posexplode(F.regexp_extract_all("content", F.lit(BLOCK), F.lit(0))).alias("at", "block"))
    strict = F.regexp_extract_all("block", F.lit("(?U)" + FIGURE), F.lit(1))
    ids = F.when(F.size(strict) > 0, strict).otherwise(F.regexp_extract_all("block", F.lit("(?U)" + ANY_FIGURE), F.lit(1)))
    figures = blocks.select(key, "at", "block", F.posexplode_outer(ids).alias("place", "_figure"))
    told = descriptions.groupBy(F.col(figure).alias("_figure")).agg(F.max(description).alias("_told"))
    lines = figures.join(told, "_figure", "left").groupBy(key, "at", "block").agg(F.array_sort(F.collect_list(F.when(F.col("_figure").isNotNull(), F.struct("place", block_lines(F.col("_figure"), F.col("_told")).alias("line"))))).alias("lines"))
    anew = F.when(F.size("lines") == 0, F.col("block")).otherwise(F.concat(F.lit(OPEN + " "), F.array_join(F.col("lines.line"), " "), F.lit(" " + CLOSE)))
    written = lines.select(key, "at", anew.alias("anew")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "anew"))).alias("blocks"))
    parts = F.split("content", BLOCK, -1)
    between = F.zip_with(parts, F.coalesce(F.col("blocks.anew"), F.array().cast("array<string>")), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    patched = broken.join(written, key, "left").select(key, F.array_join(between, "").alias("content"))
    again = _with_status(patched, key).select(key, F.col("content").alias("patched"), "status")
    out = first.join(checked, key).join(again, key, "left")
    status = F.when(F.col("was") == "ok", "ok").when(F.col("status") == "ok", "fixed").when(F.col("status") == "relaxed", "relaxed").otherwise("failed")
    return out.select(key, status.alias("status"), F.when(F.col("status").isin("ok", "relaxed"), F.col("patched")).otherwise(F.col("content")).alias("content"))
