"""Relational operators on small tables."""

import json

from pyspark.sql import functions as F

from loomwright.operators import cards, links, quality, regions, windows
from loomwright.sources import readers, sinks
from loomwright.streaming import upserts


def test_link_table(spark):
    issues = spark.range(1, 8).withColumnRenamed("id", "issue_number")
    prs = spark.createDataFrame([(10, True, 2, [1]), (11, True, 2, [2]), (12, True, 0, [3]), (13, False, 0, [4]), (14, False, 0, [5])], "pr_number long, merged boolean, changed_files int, linked_issue_numbers array<long>")
    commits = spark.createDataFrame([("a1", "Fix #1", [], [10]), ("a2", "work on #4", [], [13]), ("a3", "Merge branch 'x'", [], [11]), ("a4", "Resolve issue 6", None, [])], "sha string, message string, linked_issue_numbers array<long>, pr_numbers array<long>")
    out = links.link_issues(issues, prs, commits)
    got = {r["issue_number"]: (r["link_score"], r["link_confidence"], r["resolution_status"]) for r in out.collect()}
    assert got == {
        1: (1.0, "high", "merged_fix"), 2: (0.88, "medium", "merged_fix"), 3: (0.8, "medium", "reference_only"), 4: (0.8, "medium", "candidate_fix"), 5: (0.6, "medium", "reference_only"),
        6: (0.35, "low", "commit_only_candidate"), 7: (0.0, "none", "unlinked"),
    }
    s = links.link_summary(out).first()
    assert (s["total"], s["linked"], s["link_rate"], s["merged_fix"], s["candidate_fix"], s["commit_only_candidate"], s["reference_only"]) == (7, 6, 0.8571, 2, 1, 1, 2)


def test_parts(spark):
    seven = spark.range(7).withColumn("k", F.lit("a"))
    sizes = lambda df: sorted(r["count"] for r in df.groupBy("part").count().collect())
    assert sizes(windows.even_parts(seven, ["id"], 3)) == [2, 2, 3]
    assert sizes(windows.fixed_parts(seven, ["id"], 3)) == [1, 3, 3]
    packed = windows.greedy_parts(seven, ["k"], "id", F.lit(10).cast("long"), 8, 25).orderBy("id").collect()
    assert [r["part"] for r in packed] == [0, 0, 1, 1, 2, 2, 3]


def test_greedy_parts_restart_with_each_part(spark):
    import random

    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), i, r.choice([None, 0, 3, 9, 40])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, id int, s int").repartition(3)
    got = {x["id"]: (x["k"], x["size"], x["part"]) for x in windows.greedy_parts(df, ["k"], "id", F.col("s"), 4, 20).collect()}
    state, want = {}, {}
    for k, i, s in rows:
        part, n, held = state.get(k, (0, 0, 0))
        if n and (n == 4 or held + (s or 0) > 20):
            part, n, held = part + 1, 0, 0
        state[k] = part, n + 1, held + (s or 0)
        want[i] = k, s or 0, part
    assert got == want
    assert {x["part"] for x in windows.greedy_parts(df, [], "id", F.col("s"), 10**6, 10**6).collect()} == {0}
    assert windows.greedy_parts(df.limit(0), ["k"], "id", F.col("s"), 4, 20).count() == 0


def test_upsert_and_top(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, windows.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert "WindowGroupLimit" in windows.top_per_key(spark.range(9).withColumn("k", F.col("id") % 2), ["k"], [F.col("id")], 2)._jdf.queryExecution().executedPlan().toString()


def test_gates(spark):
    a, b = spark.range(5), spark.range(3)
    assert sorted(r["id"] for r in quality.missing(a, b, ["id"]).collect()) == [3, 4]
    assert quality.repeated(a.union(b), ["id"]).count() == 3
    v = {r["rule"]: r["violations"] for r in quality.violations(a, "t", {"small": F.col("id") < 3, "there": F.lit(None).cast("boolean")}).collect()}
    assert v == {"small": 2, "there": 5}


def test_regions(spark):
    boxes = spark.createDataFrame([("p", 0, 0, 10, 10), ("p", 45, 0, 10, 10), ("p", 90, 0, 10, 10), ("p", 500, 500, 5, 5)], "page string, x long, y long, w long, h long")
    assert sorted(tuple(r)[1:] for r in regions.merge_close(boxes, "page").collect()) == [(0, 0, 100, 10), (500, 500, 5, 5)]


def test_cards(spark):
    row = spark.range(1).select(cards.lines(("A", F.lit(1)), ("B", F.lit(None)), ("C", cards.flag_text(F.lit(True))), ("D", cards.none_text(F.lit(None).cast("int")))).alias("t")).first()
    assert row["t"] == "A: 1\nC: True\nD: None"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps([{"repo": "r", "issue_number": 1, "labels": ["x"]}]))
    (tmp_path / "in/b.json").write_text("[{broken")
    assert [(r["repo"], r["issue_number"]) for r in readers.json_arrays(spark, str(tmp_path / "in"), readers.ISSUES).collect()] == [("r", 1)]
    (tmp_path / "tree/sub").mkdir(parents=True)
    (tmp_path / "tree/sub/x.c").write_bytes("é".encode("latin-1"))
    (tmp_path / "tree/y.md").write_text("version https://git-lfs.github.com/spec/v1")
    got = {r["path"]: (r["content"], r["encoding"], r["is_pointer"]) for r in readers.file_tree(spark, str(tmp_path / "tree")).collect()}
    assert got["sub/x.c"] == ("é", "latin-1", False) and got["y.md"][2]
    modules = spark.createDataFrame([('[submodule "a"]\n\tpath = lib/a\n\turl = https://x/a.git\n',)], "content string")
    assert tuple(readers.submodules(modules).first()) == ("lib/a", "https://x/a.git")
    df = spark.createDataFrame([("a", 1, "xx"), ("a", 2, "y"), ("b", 3, "z")], "part string, id int, text string")
    payloads = {r["part"]: json.loads(r["payload"]) for r in sinks.wrapped(df, "documents", "part").collect()}
    assert len(payloads["a"]["documents"]) == 2
    assert {r["part"]: r["docs"] for r in sinks.manifest(df, "part", "text").collect()} == {"a": 2, "b": 1}
    sinks.partitioned(df, str(tmp_path / "out"), ["part"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_stream_upsert(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    schema = "k int, v string"
    for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        upserts.upsert_stream(spark.readStream.schema(schema).parquet(source), target, ["k"], str(tmp_path / "c")).awaitTermination()
    assert sorted(map(tuple, upserts.latest(spark, target).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, upserts.latest(spark, target, 1).collect())) == [(1, "a"), (2, "b")]


def test_stream_upsert_touches_only_its_buckets(spark, tmp_path):
    import os

    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    want, schema = {}, "k int, v string"
    for n, keys in enumerate((range(40), [3], [3, 50], [3])):
        rows = [(k, f"{n}") for k in keys]
        want.update(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        upserts.upsert_stream(spark.readStream.schema(schema).parquet(source), target, ["k"], str(tmp_path / "c"), buckets=8).awaitTermination()
    assert sorted(map(tuple, upserts.latest(spark, target).collect())) == sorted(want.items())
    folders = {b: [f for f in os.listdir(f"{target}/{b}") if f.startswith("bucket=")] for b in os.listdir(target) if b.startswith("batch=")}
    assert len(folders["batch=000000003"]) == 1 and len(folders["batch=000000000"]) < 8
    # A batch that was not finished is not read.
    os.makedirs(f"{target}/batch=000000009/bucket=0")
    assert upserts.latest(spark, target).count() == len(want)


def test_nearest_vectors(spark):
    import numpy as np

    from loomwright.operators import vectors

    r = np.random.default_rng(1)
    some = [(i, r.integers(-3, 4, 6).astype(float).tolist()) for i in range(90)] + [(90, None), (91, [0.0] * 6), (92, [1.0] * 6), (93, [2.0] * 6), (None, [1.0] * 6)]
    rows = spark.createDataFrame(some, "vec_id long, embedding array<float>").repartition(3)
    valid = [(i, np.array(v) / np.linalg.norm(v)) for i, v in some if i is not None and v and any(v)]
    got = sorted(map(tuple, vectors.nearest(rows.where("vec_id % 4 = 0"), rows, 3, block=16).select("q", "vec_id", "sim", "rank").collect()))
    want = []
    for i, x in valid:
        if i % 4 == 0:
            near = sorted((-round(float(x @ y), 5), j) for j, y in valid if j != i)[:3]
            want += [(i, j, -s, n) for n, (s, j) in enumerate(near, 1)]
    assert [(q, v, n) for q, v, _, n in got] == sorted((q, v, n) for q, v, _, n in want)
    assert np.allclose([g[2] for g in got], [w[2] for w in sorted(want)], atol=1e-9)
    assert vectors.nearest(rows.limit(0), rows, 3).count() == 0


def test_full_outer_cards_matches_whole_passages(spark, tmp_path):
    from loomwright.plans.cards import full_outer_cards

    long = "a passage of the benchmark that is longer than forty characters"
    made = {"benchmark": ([(1, long), (2, "short one"), (3, "")], "item_id long, text string"), "labels": ([(1, 1)], "doc_id long, quality int")}
    made["documents"] = ([(1, f"x {long} y"), (2, long[:50]), (3, "a short one here"), (4, "none")], "doc_id long, text string")
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(map(tuple, full_outer_cards(spark, str(tmp_path)).collect())) == [(1, 1, 1), (3, None, 1)]
