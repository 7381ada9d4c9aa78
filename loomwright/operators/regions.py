"""Rectangles: overlap, and merging of close ones on a page."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwright.durable import stored

#: The gap over which rectangles are merged, and the bounds of a figure region (fixed values).
GAP, LEAST_WIDTH, LEAST_HEIGHT, LEAST_SHARE, MOST_SHARE = 40, 180, 140, 0.03, 0.92


def intersection(a: Column, b: Column) -> Column:
    """Area that two struct(x, y, w, h) have in common."""
    w = F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"])
    h = F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"])
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def is_figure(box: Column, page_area: Column) -> Column:
    share = box["w"] * box["h"] / page_area
    return (box["w"] >= LEAST_WIDTH) & (box["h"] >= LEAST_HEIGHT) & share.between(LEAST_SHARE, MOST_SHARE) & (box["w"] / box["h"]).between(0.12, 15.0)


def text_share(box: Column, texts: Column) -> Column:
    """The share of a box that text boxes (array of structs) cover, at most 1; their areas are summed."""
    covered = F.aggregate(texts, F.lit(0).cast("long"), lambda s, t: s + intersection(box, t).cast("long"))
    return F.when(box["w"] * box["h"] <= 0, 0.0).otherwise(F.least(covered / (box["w"] * box["h"]), F.lit(1.0)))


def figures(boxes: DataFrame, page: str, page_area: Column, texts: DataFrame, gap: int = GAP, most_text: float = 0.65) -> DataFrame:
    """(page, rank, x, y, w, h): outlines of a page's ink that may be figures, merged where close, without those mostly of text, by (y, x).

    texts: page, texts (array of boxes)."""
    box = F.struct("x", "y", "w", "h")
    merged = merge_close(boxes.where(is_figure(box, page_area)), page, gap).join(texts, page, "left")
    none = F.array().cast("array<struct<x:bigint,y:bigint,w:bigint,h:bigint>>")
    kept = merged.where(text_share(box, F.coalesce("texts", none)) <= most_text)
    return kept.select(page, (F.row_number().over(Window.partitionBy(page).orderBy("y", "x")) - 1).alias("rank"), "x", "y", "w", "h")


def figure_id(repo: Column, path: Column, page: Column, rank: Column) -> Column:
    """repo:path:p<page>:f<figure>, counted from 1."""
    return F.concat_ws(":", repo, path, F.concat(F.lit("p"), page.cast("string")), F.concat(F.lit("f"), (rank + 1).cast("string")))


#: Sides of a page in bins: a hull lies in no more than so many bins a side, and one more.
BINS = 16


def close_pairs(boxes: DataFrame, page: str, gap: int) -> DataFrame:
    """(page, a, b): the ids of two boxes of a page no farther apart than gap, from boxes (page, id, x1, y1, x2, y2).

    Boxes are entered into the bins of a grid that they reach; only those of one bin are compared."""
    extent = boxes.groupBy(F.col(page).alias("_p")).agg(F.min("x1").alias("_left"), F.min("y1").alias("_top"), F.greatest(F.max("x2") - F.min("x1"), F.max("y2") - F.min("y1")).alias("_side"))
    wide = boxes.join(extent, F.col(page).eqNullSafe(F.col("_p"))).withColumn("_bin", F.greatest(F.ceil(F.col("_side") / BINS), F.lit(gap + 1)))
    bins = lambda low, high, start: F.explode(F.sequence(F.floor((F.col(low) - F.col(start)) / F.col("_bin")), F.floor((F.col(high) + gap - F.col(start)) / F.col("_bin"))))
    placed = wide.withColumn("_i", bins("x1", "x2", "_left")).withColumn("_j", bins("y1", "y2", "_top")).select(F.col(page).alias("_p"), "_i", "_j", "id", "x1", "y1", "x2", "y2")
    a, b = placed.alias("a"), placed.alias("b")
    near = (F.col("a.x1") <= F.col("b.x2") + gap) & (F.col("b.x1") <= F.col("a.x2") + gap) & (F.col("a.y1") <= F.col("b.y2") + gap) & (F.col("b.y1") <= F.col("a.y2") + gap)
    same = F.col("a._p").eqNullSafe(F.col("b._p")) & (F.col("a._i") == F.col("b._i")) & (F.col("a._j") == F.col("b._j")) & (F.col("a.id") < F.col("b.id"))
    return a.join(b, same & near).select(F.col("a._p").alias(page), F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


#: Rows of a page up to which it is merged in one row of a table; pages of more are merged by joins, in rounds.
FEW = 64


def merge_close(boxes: DataFrame, page: str, gap: int = GAP) -> DataFrame:
    """(page, x, y, w, h): boxes of a page closer than gap become their hull, again and again until none are.

    Equal boxes are one; rows without a side or a corner are left out. The order of merges does not matter: what must become one
    hull is decided by the boxes alone. Pages of at most FEW rows are dealt out once and merged where they arrive; of larger ones
    no task holds a whole page."""
    start = boxes.select(page, F.col("x").cast("long").alias("x1"), F.col("y").cast("long").alias("y1"), (F.col("x") + F.col("w")).cast("long").alias("x2"), (F.col("y") + F.col("h")).cast("long").alias("y2"))
    start = start.where("x1 + y1 + x2 + y2 is not null")
    large = stored(start.groupBy(F.col(page).alias("_p")).count().where(F.col("count") > FEW).select("_p"), "large")
    if not large.limit(1).count():
        return _merge_small(start, page, gap)
    here = F.col(page).eqNullSafe(F.col("_p"))
    return _merge_small(start.join(large, here, "left_anti"), page, gap).unionByName(_merge_rounds(start.join(large, here, "left_semi"), page, gap))


def _merge_small(start: DataFrame, page: str, gap: int) -> DataFrame:
    """merge_close of boxes (page, x1, y1, x2, y2) whose pages are small: a page is one row."""
    sides = ("x1", "y1", "x2", "y2")
    pages = start.groupBy(page).agg(F.collect_set(F.struct(*sides)).alias("boxes"))
    schema = T.StructType([start.schema[page], *(T.StructField(c, T.LongType()) for c in ("x", "y", "w", "h"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            corners = np.stack([lists.flatten().field(c).to_numpy(zero_copy_only=False) for c in sides], axis=1).tolist()
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            at, hulls, begin = [], [], 0
            for i, end in enumerate(ends):
                found = merged_boxes(corners[begin:end], gap)
                hulls += found
                at += [i] * len(found)
                begin = end
            x1, y1, x2, y2 = np.array(hulls, dtype=np.int64).reshape(-1, 4).T
            told = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(np.ascontiguousarray(v)) for v in (x1, y1, x2 - x1, y2 - y1))]
            yield pa.RecordBatch.from_arrays(told, names=[page, "x", "y", "w", "h"])

    return pages.mapInArrow(run, schema)


def merged_boxes(boxes: list[list[int]], gap: int) -> list[list[int]]:
    """The hulls of a page's boxes [x1, y1, x2, y2]: each box takes in the hulls near it until none is near."""
    hulls: list[list[int]] = []
    for x1, y1, x2, y2 in boxes:
        while True:
            apart = [q for q in hulls if x1 > q[2] + gap or q[0] > x2 + gap or y1 > q[3] + gap or q[1] > y2 + gap]
            if len(apart) == len(hulls):
                break
            near = [q for q in hulls if not (x1 > q[2] + gap or q[0] > x2 + gap or y1 > q[3] + gap or q[1] > y2 + gap)]
            x1, y1, x2, y2 = min(x1, *(q[0] for q in near)), min(y1, *(q[1] for q in near)), max(x2, *(q[2] for q in near)), max(y2, *(q[3] for q in near))
            hulls = apart
        hulls.append([x1, y1, x2, y2])
    return hulls


def _merge_rounds(start: DataFrame, page: str, gap: int) -> DataFrame:
    """merge_close of boxes (page, x1, y1, x2, y2) on pages of any size.

    Each round gives every box the smallest id among those close to it and to them, and joins the boxes of one id to their hull; pages
    without close boxes are done and leave the rounds."""
    start = start.distinct()
    work, done = stored(start.withColumn("id", F.monotonically_increasing_id()), "boxes"), []
    while True:
        pairs = stored(close_pairs(work, page, gap), "pairs")
        if not pairs.limit(1).count():
            break
        both = pairs.select(page, "a", "b").unionByName(pairs.select(page, F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("least"))
        # The label of the label too, so that chains shorten by more than a box a round.
        twice = least.join(least.select(F.col("id").alias("least"), F.col("least").alias("further")), "least", "left").select("id", F.coalesce("further", "least").alias("label"))
        moving = pairs.select(F.col(page).alias("_p")).distinct()
        done.append(work.join(moving, F.col(page).eqNullSafe(F.col("_p")), "left_anti").drop("id"))
        active = work.join(moving, F.col(page).eqNullSafe(F.col("_p")), "left_semi").join(twice, "id", "left").withColumn("label", F.coalesce("label", "id"))
        hulls = active.groupBy(page, "label").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
        work = stored(hulls.withColumnRenamed("label", "id").select(page, "x1", "y1", "x2", "y2", "id"), "boxes")
    out = work.drop("id")
    for part in done:
        out = out.unionByName(part)
    return out.select(page, F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
