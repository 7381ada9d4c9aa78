"""Committed files and the stream of changes: failed attempts, repeats and restarts."""

import json
import os
import random

import pytest
from loomwright.sources import committed, paged
from pyspark.sql import functions as F


def listed(folder):
    return sorted(os.listdir(folder))


def test_a_failed_attempt_leaves_nothing(tmp_path):
    folder = str(tmp_path)

    def breaks():
        yield "a.json", "1"
        yield "b.json", "2"
        raise OSError("lost")

    writer = committed.FilesWriter(folder, "array")
    with pytest.raises(OSError):
        writer.write(breaks())
    second = writer.write(iter([("a.json", "1"), ("a.json", '{"x": 2}'), ("b.json", None)]))
    assert [n for n in listed(folder) if not n.startswith("_")] == []
    writer.commit([second, None])
    assert listed(folder) == ["a.json", "b.json"]
    assert json.loads((tmp_path / "a.json").read_text()) == [1, {"x": 2}] and json.loads((tmp_path / "b.json").read_text()) == [None]


def test_a_failed_job_leaves_the_files_before_it(spark, tmp_path):
    folder = f"{tmp_path}/cards"
    committed.save_files(spark.createDataFrame([("a.md", "one"), ("b.md", None)], "name string, text string"), folder, "text")
    bad = spark.createDataFrame([("a.md", "two"), ("c.md", "three"), ("sub/d.md", "four")], "name string, text string").coalesce(1)
    with pytest.raises(Exception, match="not a file name"):
        committed.save_files(bad, folder, "text")
    assert listed(folder) == ["a.md", "b.md"] and open(f"{folder}/a.md").read() == "one"
    twice = spark.createDataFrame([("a.md", "two"), ("a.md", "three")], "name string, text string").repartition(2, "text")
    with pytest.raises(Exception, match="two"):
        committed.save_files(twice, folder, "text")
    assert open(f"{folder}/a.md").read() == "one" and listed(folder) == ["a.md", "b.md"]


def test_one_array_for_each_repository(spark, tmp_path):
    r = random.Random(1)
    rows = [(r.choice(["o/hot", "o/hot", "o/b", None]), k, r.choice(['say "x"', None, "é\n"])) for k in range(300)]
    df = spark.createDataFrame(rows, "repo string, number long, body string").repartition(7)
    committed.json_array_files(df, f"{tmp_path}/issues", "repo")
    assert listed(f"{tmp_path}/issues") == ["o_b.json", "o_hot.json"]
    back = committed.read_arrays(spark, f"{tmp_path}/issues", "repo string, number long, body string")
    assert sorted((x["repo"], x["number"], x["body"] or "") for x in back.collect()) == sorted((a, b, c or "") for a, b, c in rows if a)
    committed.json_array_files(df.limit(0), f"{tmp_path}/none", "repo")
    assert not os.path.exists(f"{tmp_path}/none") or listed(f"{tmp_path}/none") == []


def test_cards_and_their_manifest(spark, tmp_path):
    df = spark.createDataFrame([(f"{k}-x.md", f"# {k}", k, 'a "b", c') for k in range(20)], "file string, card string, number long, title string").repartition(4)
    committed.card_files(df, f"{tmp_path}/cards", "file", "card", ["number", "title"])
    assert len(listed(f"{tmp_path}/cards")) == 21 and open(f"{tmp_path}/cards/7-x.md").read() == "# 7"
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/cards/manifest.csv")
    assert sorted(map(tuple, back.collect())) == sorted((f"{k}-x.md", str(k), 'a "b", c') for k in range(20))


def service(path):
    def fetch(address, parameters):
        with open(path) as file:
            rows = json.load(file)
        rows = [r for r in rows if r["updated_at"] >= parameters["since"]]
        rows.sort(key=lambda r: (r["updated_at"], r["number"]), reverse=parameters["direction"] == "desc")
        at = (parameters["page"] - 1) * parameters["per_page"]
        return rows[at : at + parameters["per_page"]]

    return fetch


def change(number, time, **more):
    return {"number": number, "updated_at": f"2024-01-01T{time:06}Z", "title": f"t{number}", "state": "open", "labels": [], **more}


def test_changes_of_one_time_fill_pages(tmp_path):
    rows = [change(k, 1) for k in range(250)] + [change(300 + k, 2 + k) for k in range(150)]
    path = f"{tmp_path}/rows.json"
    json.dump(rows, open(path, "w"))
    got = [x["number"] for x in paged.changed_since(service(path), "o/r", "", rows[-1]["updated_at"])]
    assert sorted(got) == sorted(r["number"] for r in rows) and len(got) == 400
    some = [x["number"] for x in paged.changed_since(service(path), "o/r", rows[260]["updated_at"], rows[300]["updated_at"])]
    assert some == [r["number"] for r in rows[261:301]]


def test_a_restarted_stream_loses_and_repeats_nothing(spark, tmp_path):
    path = f"{tmp_path}/rows.json"
    first = [change(k, k // 3) for k in range(120)] + [change(500, 7, pull_request={})]
    json.dump(first, open(path, "w"))
    spark.dataSource.register(paged.change_stream("t_changes", service(path), wait=0.0))

    def run():
        stream = spark.readStream.format("t_changes").option("repos", "o/r").load()
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted((r["issue_number"], r["updated_at"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == sorted((r["number"], r["updated_at"]) for r in first)
    assert len(run()) == len(first)
    second = [change(3, 100), change(600, 101), change(601, 101)]
    json.dump([r for r in first if r["number"] != 3] + second, open(path, "w"))
    assert run() == sorted((r["number"], r["updated_at"]) for r in first + second)
    assert spark.read.parquet(f"{tmp_path}/out").where(F.col("is_request")).count() == 1


def test_commits_meet_by_a_shuffle(spark):
    store = {f"o/{r}/commits/s{k}": {"commit": {"message": f"m{k}"}, "files": [{"filename": "x.c"}]} for r in "ab" for k in range(5)}
    refs = spark.createDataFrame([(f"o/{r}", f"s{k}", n) for r in "ab" for k in range(5) for n in (9, k, 9)] + [("o/a", None, 1)], "repo string, sha string, number long").repartition(4)
    got = {(r["repo"], r["sha"]): (r["pr_numbers"], r["message"], r["files_changed"][0]["filename"]) for r in paged.commit_details(refs, lambda a, p: store[a], wait=0.0).collect()}
    assert got == {(f"o/{r}", f"s{k}"): ([k, 9], f"m{k}", "x.c") for r in "ab" for k in range(5)}
    assert paged.commit_details(refs.limit(0), lambda a, p: store[a]).count() == 0
