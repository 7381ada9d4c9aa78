"""Running sums, row numbers and greedy cuts over an order, without a task that holds a whole key or table.

Rows are dealt out by ranges of (keys, order). Sums inside a range come from a window, those of earlier ranges from one
row for each range: a key only continues from an earlier range in the first rows of a range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.durable import stored


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column], last: Sequence[Column] = ()) -> DataFrame:
    """df with, for each name, the sum of its column over the rows before a row of its key, in this order; ties of the order by `last`, then all alike.

    Nulls come first, in keys and order. The result is read from a stored table, so numbers do not change when a part is computed again.
    """
    names = list(sums)
    valued = df.select("*", *(F.coalesce(c, F.lit(0)).cast("long").alias(f"_of_{n}") for n, c in sums.items()), *(c.alias(f"_last_{i}") for i, c in enumerate(last)))
    order = [*order, *(f"_last_{i}" for i in range(len(last)))]
    count = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # The tie only parts rows that are alike, and is stored, so that all sums see one order.
    tied = valued.withColumn("_tie", F.monotonically_increasing_id())
    ranged = stored(tied.repartitionByRange(count, *keys, *order, "_tie").withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_range", *keys).agg(*(F.sum(f"_of_{n}").alias(f"_sum_{n}") for n in names))
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *(F.col(k).alias(f"_key_{k}") for k in keys), *(F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in names))
    # Only the first key of a range goes on from an earlier one: no more rows than ranges.
    offsets = offsets.where(F.coalesce(*(F.col(f"_before_{n}") for n in names)).isNotNull()).withColumnRenamed("_range", "_in")
    same = F.col("_range") == F.col("_in")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    inside = Window.partitionBy("_range", *keys).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    both = ranged.join(F.broadcast(offsets), same, "left")
    return both.select(*df.columns, *((F.coalesce(F.col(f"_before_{n}"), F.lit(0)) + F.coalesce(F.sum(f"_of_{n}").over(inside), F.lit(0))).alias(n) for n in names))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "number", last: Sequence[Column] = ()) -> DataFrame:
    """df with each row's number in its key, from 0."""
    return running(df, keys, order, {out: F.lit(1)}, last)


def _null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """a joined with b on keys that may be null; b's keys are dropped."""
    renamed = b
    same = F.lit(True)
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_right_{k}")
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return a.join(renamed, same, how).drop(*(f"_right_{k}" for k in keys))


def halves(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: Column, most: int, out: str) -> DataFrame:
    """df with the number of each row's segment: a key's rows in order are cut in the middle, and the halves again, until a segment is within `most` or one row.

    A table of running sums answers each round: a segment that is too large looks its middle up there. Only segments that are
    still too large take part in a round, so a round reads the sums and shuffles no row of df.
    """
    placed = stored(running(df, keys, order, {"_number": F.lit(1), "_sum": size}), "placed")
    sums = placed.select(*keys, F.col("_number").alias("_mid"), F.col("_sum").alias("_at_mid"))
    open_ = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hi"), F.sum(size).alias("_at_hi")).select(*keys, F.lit(0).cast("long").alias("_lo"), "_hi", F.lit(0).cast("long").alias("_at_lo"), F.coalesce("_at_hi", F.lit(0)).cast("long").alias("_at_hi"))
    done = []
    while True:
        large = (F.col("_at_hi") - F.col("_at_lo") > most) & (F.col("_hi") - F.col("_lo") > 1)
        open_ = stored(open_.withColumn("_large", large), "segments")
        done.append(open_.where("not _large").select(*keys, "_lo"))
        split = open_.where("_large").withColumn("_mid", F.col("_lo") + F.floor((F.col("_hi") - F.col("_lo")) / 2))
        if not split.limit(1).count():
            break
        met = _null_safe(split, sums, [*keys, "_mid"], "inner")
        pair = F.explode(F.array(F.struct("_lo", F.col("_mid").alias("_hi"), "_at_lo", F.col("_at_mid").alias("_at_hi")), F.struct(F.col("_mid").alias("_lo"), "_hi", F.col("_at_mid").alias("_at_lo"), "_at_hi")))
        open_ = met.select(*keys, pair.alias("_s")).select(*keys, "_s.*")
    starts = done[0]
    for more in done[1:]:
        starts = starts.unionByName(more)
    marked = _null_safe(placed, starts.withColumn("_start", F.lit(1)).withColumnRenamed("_lo", "_number"), [*keys, "_number"], "left")
    # Sub parts begin at the marked rows: a row's is the marks up to it, less one.
    counted = running(marked, keys, ["_number"], {"_marks": F.col("_start")})
    return counted.withColumn(out, (F.col("_marks") + F.coalesce("_start", F.lit(0)) - 1).cast("int")).drop("_number", "_sum", "_start", "_marks")


def next_starts(placed: DataFrame, keys: Sequence[str], most_rows: int, most_size: int) -> DataFrame:
    """(keys, _number, _next) from rows with their number and the sum and size before and of them: where the next part begins if one begins here.

    That is the first later row whose sum passes this row's limit, or which is most_rows on. Rows (by the sum up to and with them) and
    limits are sorted together by value; the rows before a limit in that order are those that still fit.
    """
    upto = placed.select(*keys, (F.col("_sum") + F.col("_size")).alias("_value"), F.lit(0).alias("_kind"), "_number", F.lit(1).alias("_fits"))
    limits = placed.select(*keys, (F.col("_sum") + F.lit(most_size)).alias("_value"), F.lit(1).alias("_kind"), "_number", F.lit(0).alias("_fits"))
    # How many rows of the key have a sum within the limit: sums do not fall, so these are the first ones.
    ranked = running(upto.unionByName(limits), keys, ["_value", "_kind", "_number"], {"_within": F.col("_fits")}).where("_kind = 1")
    after = F.greatest(F.col("_number") + 1, F.least(F.col("_within"), F.col("_number") + F.lit(most_rows)))
    return ranked.select(*keys, "_number", after.alias("_next"))


def greedy_starts(placed: DataFrame, keys: Sequence[str], most_rows: int, most_size: int, block: int = 1 << 16) -> DataFrame:
    """(keys, _number) of the rows where greedy parts begin, from placed(keys, _number, _sum, _size).

    Where the next part begins hangs on where this one does and on nothing before, so parts follow pointers. A task follows them
    inside a block of rows, for every row at once, up to the last start in the block. What is left, one pointer from block
    to block for each such last start, is followed by doubling: the reached set grows and pointers are squared until nothing is new.
    """
    following = next_starts(placed, keys, most_rows, most_size)
    kinds = [f"`{k}` {placed.schema[k].dataType.simpleString()}" for k in keys]
    blocked = stored(following.withColumn("_block", F.floor(F.col("_number") / block)), "pointers")

    def last_starts(table: pa.Table) -> pa.Table:
        table = table.sort_by("_number")
        number, after = table["_number"].to_numpy(), table["_next"].to_numpy()
        first, n = int(number[0]), len(number)
        inside = np.minimum(after - first, n)
        end = np.arange(n)
        for i in range(n - 1, -1, -1):
            if inside[i] < n:
                end[i] = end[inside[i]]
        return pa.table([*(table[k] for k in keys), table["_number"], pa.array(first + end, pa.int64()), pa.array(after[end], pa.int64())], [*keys, "_number", "_end", "_out"])

    schema = ", ".join([*kinds, "_number long", "_end long", "_out long"])
    ends = stored(blocked.groupBy(*keys, "_block").applyInArrow(last_starts, schema), "ends")
    # From a block's last start to that of the block in which its part ends.
    target = ends.select(*keys, F.col("_number").alias("_out"), F.col("_end").alias("_to"))
    jumps = _null_safe(ends.select(*keys, "_end", "_out").distinct(), target, [*keys, "_out"], "inner").select(*keys, "_end", "_to")
    jumps = stored(jumps, "jumps")
    reached = stored(ends.where("_number = 0").select(*keys, "_end"), "reached")
    while True:
        further = _null_safe(reached, jumps, [*keys, "_end"], "inner").select(*keys, F.col("_to").alias("_end"))
        new = _null_safe(further.distinct(), reached, [*keys, "_end"], "left_anti")
        new = stored(new, "new")
        if not new.limit(1).count():
            break
        reached = reached.unionByName(new)
        jumps = stored(_null_safe(jumps, jumps.select(*keys, F.col("_end").alias("_to"), F.col("_to").alias("_far")), [*keys, "_to"], "inner").select(*keys, "_end", F.col("_far").alias("_to")), "jumps")
    # Each block is entered where the part of the last start before it ends; the first one at its first row.
    entered = _null_safe(ends.select(*keys, "_end", "_out").distinct(), reached, [*keys, "_end"], "left_semi").select(*keys, F.col("_out").alias("_number"))
    first = blocked.where("_number = 0").select(*keys, "_number")
    entries = entered.unionByName(first).distinct().withColumn("_entry", F.lit(True))
    marked = _null_safe(blocked, entries, [*keys, "_number"], "left")

    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by("_number")
        number, after = table["_number"].to_numpy(), table["_next"].to_numpy()
        entry = np.flatnonzero(table["_entry"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False))
        starts, at, first, n = [], int(entry[0]) if len(entry) else len(number), int(number[0]), len(number)
        while at < n:
            starts.append(at)
            at = int(after[at]) - first
        return table.select([*keys, "_number"]).take(pa.array(starts, pa.int64()))

    return marked.groupBy(*keys, "_block").applyInArrow(follow, ", ".join([*kinds, "_number long"]))
