"""Changes by key across batches and restarts, and first-seen rows within the watermark."""

import datetime as dt

from loomwright.streaming import changes, upserts

SCHEMA = "k string, v string, at long, _told int"


def test_late_repeated_and_unchanged_rows_across_restarts(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def run(rows):
        spark.createDataFrame([(*r, 1) for r in rows], SCHEMA.replace("_told", "n")).coalesce(1).write.mode("append").parquet(source)
        stream = changes.changed(spark.readStream.schema(SCHEMA.replace("_told", "n")).parquet(source), ["k"], "at")
        query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(((r["k"] or "", r["at"], r["v"]) for r in spark.read.parquet(out).collect()), key=str)

    first = run([("a", "1", 5), ("a", "0", 3), ("b", "x", 1), (None, "n", 1), ("a", "1", 5), ("c", None, 2), ("d", "no place", None)])
    assert first == sorted([("a", 5, "1"), ("b", 1, "x"), ("", 1, "n"), ("c", 2, None)], key=str)
    second = run([("a", "late", 4), ("a", "1", 9), ("b", "y", 2), ("c", None, 2), (None, "m", 1)])
    assert second == sorted([*first, ("b", 2, "y")], key=str)
    third = run([("a", "1", 7), ("a", "2", 10), ("e", "z", 1), ("e", "w", 1)])
    assert [r for r in third if r[0] != "e"] == sorted([*second, ("a", 10, "2")], key=str)
    assert sum(r[0] == "e" for r in third) == 1


def test_first_seen_within_the_watermark(spark, tmp_path):
    source = f"{tmp_path}/in"
    t = lambda minute: dt.datetime(2024, 1, 1, 0, minute)

    def run(rows):
        spark.createDataFrame(rows, "k string, at timestamp, v int").coalesce(1).write.mode("append").parquet(source)
        stream = upserts.first_seen(spark.readStream.schema("k string, at timestamp, v int").parquet(source), ["k"], "at", "10 minutes")
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run([("a", t(0), 1), ("b", t(1), 2)]) == [("a", 1), ("b", 2)]
    assert run([("a", t(5), 3), ("c", t(6), 4)]) == [("a", 1), ("b", 2), ("c", 4)]
