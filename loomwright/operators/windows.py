"""Rankings, deduplication by preference, ordered distinct, and dealing rows into parts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwright.functions.rules import let
from loomwright.durable import stored
from loomwright.operators import ranges


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first k rows of each key. Spark limits groups before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return out.withColumnRenamed("_rank", rank) if rank else out.drop("_rank")


def prefer(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first in the given order (valid before invalid, latest, first seen)."""
    return top_per_key(df, keys, order, 1)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Rows of old and new; for a key in both the new row wins, of several in one of them the first by `order`, then by all columns."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    rest = [F.col(c) for c in old.columns if c not in keys and old.schema[c].dataType.typeName() not in ("map", "variant")]
    return prefer(both, keys, [F.desc("_batch"), *order, *rest]).drop("_batch")


def ordered_distinct(items: Column, most: int | None = None, fold_case: bool = True) -> Column:
    """Items in order of their first place, each once, at most so many; case-insensitive on demand.

    array_distinct keeps the first place and hashes; places are looked up only where something is repeated."""
    def folded(xs: Column) -> Column:
        first = lambda low, once: F.transform(once, lambda x: F.get(xs, (F.array_position(low, x) - 1).cast("int")))
        return let(F.transform(xs, F.lower), lambda low: let(F.array_distinct(low), lambda once: F.when(F.size(once) == F.size(xs), xs).otherwise(first(low, once))))

    out = let(items, folded) if fold_case else F.array_distinct(items)
    return F.slice(out, 1, most) if most else out


def fixed_parts(df: DataFrame, order: Sequence[str], size: int, keys: Sequence[str] = (), out: str = "part") -> DataFrame:
    """Parts of `size` rows in order within each key, numbered from 0. Rows are numbered by ranges, so a key may be any part of the table."""
    placed = ranges.numbered(df, keys, order, "_number")
    return placed.withColumn(out, F.floor(F.col("_number") / size).cast("int")).drop("_number")


def even_parts(df: DataFrame, order: Sequence[str], parts: int, keys: Sequence[str] = (), out: str = "part") -> DataFrame:
    """So many parts of nearly equal row counts, the larger ones first, numbered from 1. Rows are numbered by ranges."""
    placed = ranges.numbered(df, keys, order, "_number")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    both = ranges._null_safe(placed, counts, keys, "inner")
    least, more, at = F.floor(F.col("_rows") / parts), F.col("_rows") % parts, F.col("_number")
    wide = more * (least + 1)
    part = F.when(at < wide, F.floor(at / (least + 1))).otherwise(more + F.floor((at - wide) / F.greatest(least, F.lit(1))))
    return both.withColumn(out, (part + 1).cast("int")).drop("_number", "_rows")


#: Rows of a key that one task packs; larger keys are packed by many.
ALONE = 1 << 20


def greedy_parts(df: DataFrame, keys: Sequence[str], order: str, size: Column, most_rows: int, most_size: int, out: str = "part", alone: int = ALONE) -> DataFrame:
    """Greedy packing in order within each key: a part closes before the row that would make it too large or too long.

    Returns keys, order, size and the part, from 0. Equal places are taken by size; a null or negative size counts as 0; a row
    larger than a part has one of its own. The running size starts anew with each part, which no window frame expresses: keys
    of up to `alone` rows are read in order by an Arrow function with the state of one part, and larger ones are cut by
    ranges.greedy_starts over many tasks. Both give the same parts."""
    rows = df.select(*keys, F.col(order), F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > alone)
    if not many.limit(1).count():
        return _packed(rows, keys, order, most_rows, most_size, out)
    many = many.select(*keys).withColumn("_many", F.lit(True))
    sided = ranges._null_safe(rows, many, keys, "left") if keys else rows.withColumn("_many", F.lit(True))
    small = _packed(sided.where("_many is null").drop("_many"), keys, order, most_rows, most_size, out)
    large = sided.where("_many").drop("_many")
    placed = stored(ranges.running(large, keys, [order, "size"], {"_number": F.lit(1), "_sum": F.col("size")}).withColumn("_size", F.col("size")), "placed")
    starts = ranges.greedy_starts(placed.select(*keys, "_number", "_sum", "_size"), keys, most_rows, most_size).withColumn("_start", F.lit(1))
    marked = ranges._null_safe(placed, starts, [*keys, "_number"], "left")
    counted = ranges.running(marked, keys, ["_number"], {"_marks": F.col("_start")})
    part = (F.col("_marks") + F.coalesce("_start", F.lit(0)) - 1).cast("int")
    return small.unionByName(counted.select(*keys, order, "size", part.alias(out)))


def _packed(rows: DataFrame, keys: Sequence[str], order: str, most_rows: int, most_size: int, out: str) -> DataFrame:
    """greedy_parts of keys that one task may read."""
    dealt = rows.repartition(*keys) if keys else rows.repartition(1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part, n, held = None, 0, 0, 0
        for b in batches:
            places = zip(*(b.column(i).to_pylist() for i in range(len(keys))), strict=True) if keys else ((),) * b.num_rows
            parts = []
            for key, more in zip(places, b.column(len(keys) + 1).to_pylist(), strict=True):
                if key != last:
                    last, part, n, held = key, 0, 0, 0
                elif n + 1 > most_rows or held + more > most_size:
                    part, n, held = part + 1, 0, 0
                n, held = n + 1, held + more
                parts.append(part)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.int32())], [*b.schema.names, out])

    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.IntegerType())])
    return dealt.sortWithinPartitions(*keys, order, "size").mapInArrow(pack, schema)
