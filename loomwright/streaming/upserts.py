"""Streams of evaluation rows: keyed upserts and first-seen results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomwright.operators.windows import upsert


def upsert_stream(rows: DataFrame, target: str, keys: Sequence[str], checkpoint: str, order: Sequence[Column] = (), buckets: int = 64) -> StreamingQuery:
    """Each micro-batch replaces the rows of its keys in a Parquet table dealt into buckets by a hash of the keys.

    A batch reads and rewrites only the buckets that hold its keys, as `batch=N/bucket=B`; readers take each bucket of
    the last whole batch that wrote it. A batch that runs again overwrites its own folder alone and leaves the same.
    Bucket folders that a batch before the last one superseded are then removed. Of several new rows of a key in
    a batch the first by `order` wins, then by all columns. The number of buckets belongs to the table: keep it."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        place = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        batch.persist()
        try:
            # At most `buckets` numbers come to the driver.
            touched = {int(r[0]) for r in batch.select(place).distinct().collect()}
            if not touched:
                return
            old = _read(spark, [path for b, path in _buckets(spark, target, number).items() if b in touched])
            out = upsert(batch.limit(0) if old is None else old, batch, keys, order)
            out.withColumn("bucket", place).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch={number:09d}")
        finally:
            batch.unpersist()
        _drop_superseded(spark, target, number)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _files(spark, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _written(spark, target: str, before: int | None = None) -> list[tuple[int, int, str]]:
    """(batch, bucket, path) of all whole batches, in order of batches."""
    path, fs = _files(spark, target)
    found = []
    for s in fs.listStatus(path) if fs.exists(path) else ():
        name = s.getPath().getName()
        inside = fs.listStatus(s.getPath()) if name.startswith("batch=") and (before is None or int(name[6:]) < before) else ()
        parts = {i.getPath().getName(): i.getPath().toString() for i in inside}
        if "_SUCCESS" in parts:
            found += [(int(name[6:]), int(part[7:]), where) for part, where in parts.items() if part.startswith("bucket=")]
    return sorted(found)


def _buckets(spark, target: str, before: int | None = None) -> dict[int, str]:
    """Where each bucket's last rows lie."""
    return {bucket: where for _, bucket, where in _written(spark, target, before)}


def _read(spark, paths: list[str]) -> DataFrame | None:
    return spark.read.parquet(*paths) if paths else None


def _drop_superseded(spark, target: str, number: int) -> None:
    """Remove what no batch from the one before `number` on reads: readers of the last state and a batch that runs again keep theirs."""
    path, fs = _files(spark, target)
    needed = {*_buckets(spark, target).values(), *_buckets(spark, target, number).values()}
    for _, _, where in _written(spark, target, number):
        if where not in needed:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where), True)


def latest(spark, target: str, before: int | None = None) -> DataFrame | None:
    """The table as of the last batch (before a number, if given); None where nothing is written."""
    return _read(spark, list(_buckets(spark, target, before).values()))


def first_seen(rows: DataFrame, keys: Sequence[str], time: str, late: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen within the watermark: a cache of results by key."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))
