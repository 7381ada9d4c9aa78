"""Support operators on small tables: sources, sinks, texts, cards, audits and runs."""

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loomwright.functions import images, paths, text
from loomwright.operators import answers, audits, diagnostic, issues, quality, regions, similarity, windows, workflow
from loomwright.sources import paged, readers, sinks


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_paged_sources_retry_and_leave_requests_out(spark, tmp_path):
    log = tmp_path / "calls"
    store = {
        "o/r/issues": [{"number": k, "title": f"t{k}", "state": "open", "labels": [{"name": "bug"}], "comments": int(k == 1)} for k in range(1, 102)] + [{"number": 900, "pull_request": {}}],
        "o/r/issues/1/comments": [{"user": {"login": "a"}, "created_at": "d", "body": "hi"}],
        "o/r/pulls": [{"number": 7}, {"number": 8}], "o/r/pulls/7": {"number": 7, "title": "p", "merged": True}, "o/r/pulls/8": {"number": 8, "title": "q"}, "o/r/pulls/7/files": [{"filename": "x.c", "additions": 3}], "o/r/pulls/8/files": [],
        "o/r/pulls/7/commits": [{"sha": "s1"}], "o/r/pulls/8/commits": [{"sha": "s1"}, {"sha": "s2"}], "o/r/commits/s1": {"commit": {"message": "m1"}, "files": []}, "o/r/commits/s2": {"commit": {"message": "m2"}},
    }
    path = str(log)

    def fetch(address, parameters):
        import os

        if address == "o/r/issues" and not os.path.exists(path):
            open(path, "w").close()
            raise OSError("first call fails")
        rows = store[address]
        return rows[(parameters["page"] - 1) * 100 : parameters["page"] * 100] if "page" in parameters else rows

    for kind in ("issues", "requests", "commits"):
        spark.dataSource.register(paged.paged_source(f"t_{kind}", kind, fetch, wait=0.0))
    got = spark.read.format("t_issues").option("repos", "o/r").load().orderBy("issue_number").collect()
    assert len(got) == 101 and got[0]["comments"][0]["body"] == "hi" and log.exists()
    assert [(r["pr_number"], r["merged"], len(r["files_changed"])) for r in spark.read.format("t_requests").option("repos", "o/r").load().orderBy("pr_number").collect()] == [(7, True, 1), (8, False, 0)]
    assert {r["sha"]: r["pr_numbers"] for r in spark.read.format("t_commits").option("repos", "o/r").load().collect()} == {"s1": [7, 8], "s2": [8]}
    with pytest.raises(OSError):
        paged.retrying(lambda a, p: (_ for _ in ()).throw(OSError()), wait=0.0)("x", {})


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"x": 1, "issues": [{"k": 1}, {"k": 2}]}))
    assert sorted(r["k"] for r in readers.json_with_key(spark, str(tmp_path / "a.json"), ("cards", "issues"), "k int").collect()) == [1, 2]
    (tmp_path / "t.jsonl").write_text('{"image_id": "a", "v": "1"}\nbroken\n{"image_id": "a", "v": "2"}\n{"v": "3"}\n')
    rows = readers.json_lines(spark, str(tmp_path / "t.jsonl"), "image_id string, v string")
    assert {(r["image_id"], r["v"]) for r in answers.described(rows.coalesce(1)).collect()} == {("a", "2")}
    (tmp_path / "q.csv").write_text('strategy_id,Score\ns1,"1"\ns1,2\n,3\n')
    table = readers.csv_table(spark, str(tmp_path / "q.csv"), "strategy_id string, Score string")
    assert [r["Score"] for r in answers.strategy_matrix(table.coalesce(1)).collect()] == ["2"]
    assert sorted(r["online_score_0_to_100"] for r in answers.online_scores(table).collect()) == [1.0, 2.0, 3.0]
    for name, repos in (("config_a.json", ["r1", "r2"]), ("config_b.json", ["r2", "r3"])):
        (tmp_path / name).write_text(json.dumps({"owner": name, "repos": repos}))
    assert {r["repo"]: r["owner"] for r in readers.configs(spark, f"{tmp_path}/config*.json").collect()} == {"r1": "config_a.json", "r2": "config_a.json", "r3": "config_b.json"}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a.md", "one"), ("b.md", "zwei ü")], "file string, text string")
    sinks.text_files(rows, f"file://{tmp_path}/cards", "file", "text")
    assert (tmp_path / "cards/b.md").read_text() == "zwei ü"
    sinks.mirrored(rows, f"{tmp_path}/p", f"{tmp_path}/m", rows.groupBy().count())
    assert spark.read.json(f"{tmp_path}/m").count() == 2 and spark.read.json(f"{tmp_path}/p_summary").first()["count"] == 2
    run = spark.createDataFrame([("Q1", "ask", 1.23456, "a\nb", ["s1", "s2", "s3", "s4"], None)], "query_id string, query_text string, latency_seconds double, answer_text string, sources array<string>, error string")
    sinks.run_artifacts(run, {"persona": "p"}, f"{tmp_path}/run")
    flat = spark.read.option("header", True).csv(f"{tmp_path}/run/responses_flat").first()
    assert (flat["latency_seconds"], flat["answer_text"], flat["sources_top3"]) == ("1.235", "a b", "s1 || s2 || s3")
    assert sinks.markdown_table(spark.createDataFrame([("x", None), ("y", 2)], "scope string, n long"), ["scope", "n"], "T", ["scope"]).endswith("| scope | n |\n|---|---:|\n| x |  |\n| y | 2 |\n")


def test_texts(spark):
    assert one(spark, text.xml_metadata(F.col("x"), text.METADATA_TAGS), x="<a><Name> n </Name><license>L</license></a>") == "name: n\nlicense: L"
    assert one(spark, text.cut_at_space(F.lit("ab cd ef"), 5)) == "ab [truncated]" and one(spark, text.cut_at_space(F.lit("abcdefgh"), 5)) == "abcde [truncated]"
    assert one(spark, F.array_join(text.split_items(F.lit(" a, ,b ")), "|")) == "a|b"
    assert one(spark, text.blob_url("o", F.lit("r"), F.lit("a b/c~d.h"))).endswith("/r/blob/master/a%20b/c~d.h")
    assert one(spark, text.unescaped_url("u/", F.lit("r"), F.lit("\\a b"))) == "u/r/blob/master/a b" and one(spark, text.unescaped_url("u/", F.lit("r"), F.lit(""))) is None
    assert one(spark, text.clean_context(F.lit("a [IMAGE TEXT]  b\n\nImage-derived context:\n1. x"))) == "a b"
    assert one(spark, text.access_token(F.lit("a"), F.lit("b"), F.lit(1), F.lit(2))) == hashlib.sha1(b"a_b_1_2").hexdigest()
    raw = "{label:{{repo}} issue #{{issue_number}},rootTagPath:issues,externalURL:https://a/b}"
    want = {"label": "{{repo}} issue #{{issue_number}}", "rootTagPath": "issues", "externalURL": "https://a/b"}
    assert one(spark, text.relaxed_pairs(F.lit(f"'{raw}'"))) == want and one(spark, text.decoded_pairs(F.lit(base64.b64encode(raw.encode()).decode()))) == want
    assert one(spark, text.relaxed_pairs(F.lit("none"))) is None
    assert one(spark, text.register_header(F.lit("int a;"))).endswith("/* Full file: see GitHub link for complete register map */\nint a;")


def test_images(spark):
    told = F.create_map(F.lit("r:a.pdf:p1:f2"), F.lit("A chart"))
    kept = "Figure detected on page 1, but no technical description is available yet for r:a.pdf:p1:f9."
    assert one(spark, images.fill_placeholders(F.lit("x Figure detected on page 1, but no technical description is available yet for r:a.pdf:p1:f2. " + kept), told)) == "x A chart " + kept
    broken = '{"t": "[FIGURE_DESCRIPTIONS] - r:a.pdf:p1:f2: bad "quote" [/FIGURE_DESCRIPTIONS]"}'
    assert json.loads(one(spark, images.rebuilt_figure_blocks(F.lit(broken), told)))["t"] == "[FIGURE_DESCRIPTIONS] - r:a.pdf:p1:f2: A chart [/FIGURE_DESCRIPTIONS]"
    assert one(spark, images.is_image_url(F.lit("<https://objects.githubusercontent.com/x>"))) and not one(spark, images.is_image_url(F.lit("ftp://x/a.png")))


def test_figures(spark):
    boxes = spark.createDataFrame([(1, 0, 0, 300, 200), (1, 320, 0, 300, 200), (1, 0, 900, 400, 300), (1, 0, 500, 50, 50)], "page int, x long, y long, w long, h long")
    texts = spark.createDataFrame([(1, [(0, 900, 400, 250)])], "page int, texts array<struct<x:bigint,y:bigint,w:bigint,h:bigint>>")
    out = regions.figures(boxes, "page", F.lit(1_000_000), texts).collect()
    assert [(r["rank"], r["x"], r["y"], r["w"], r["h"]) for r in out] == [(0, 0, 0, 620, 200)]
    assert one(spark, regions.figure_id(F.lit("r"), F.lit("a.pdf"), F.lit(1), F.lit(0))) == "r:a.pdf:p1:f1"


def test_audits(spark):
    rows = spark.createDataFrame([("a",), ("TODO here",)], "t string")
    assert audits.placeholder_gate(rows, "t", "TODO", "Warn") == 1 and audits.placeholder_gate(rows, "t", "TODO", "Off") == 0
    with pytest.raises(ValueError):
        audits.placeholder_gate(rows, "t", "TODO")
    problem = lambda p, r, roots: one(spark, audits.upload_problem(F.lit(p), F.lit(r), F.array(*map(F.lit, roots)).cast("array<string>")))
    assert [problem("standard", "", ["files"]), problem("json", "", ["files"]), problem("json", "x", ["files"]), problem("JSON", "Files", ["files"]), problem("", "", ["files"]), problem("", "", [])] == ["standard_needs_array", "root_missing", "root_differs", None, "processor_unknown", None]
    links = spark.createDataFrame([(1, '{"n": 1, "s": "ok"}'), (2, "broken"), (3, '{"n": -1, "s": "ok"}'), (4, None)], "k int, raw string")
    assert {r["k"]: r["status"] for r in quality.json_rows(links, "raw", "n int, s string", {"n": F.col("n") > 0, "s": F.col("s") == "ok"}, "k").collect()} == {1: "ok", 2: "missing", 3: "invalid", 4: "missing"}
    mixed = audits.split_mixed(spark.createDataFrame([("i", 1), ("p", 2)], "kind string, v int"), "kind", {"i": "issues", "p": "pulls"})
    assert mixed["p"].first()["rootTagPath"] == "pulls" and mixed["i"].count() == 1
    gain = quality.density_gain(spark.createDataFrame([("all", 0.5)], "scope string, density_chars double"), spark.createDataFrame([("all", 0.75)], "scope string, density_chars double")).first()
    assert gain["gain_pct"] == 50.0


def test_upsert_ties_and_preferred_sources(spark):
    new = spark.createDataFrame([(1, "b", 2), (1, "a", 3)], "k int, v string, at int")
    assert [r["v"] for r in windows.upsert(new.limit(0), new, ["k"], [F.desc("at")]).collect()] == ["a"]
    entries = spark.createDataFrame([("n", 1, "{}"), ("n", 5, '{"deleted": true}'), ("m", 2, '{"status": "removed"}')], "name string, id int, raw string")
    assert {r["name"]: r["id"] for r in answers.preferred_source(entries, ["name"]).collect()} == {"n": 1, "m": 2}


def test_scopes_and_order(spark):
    prs = spark.createDataFrame([(1, True, [2]), (2, True, []), (3, False, [1]), (4, False, None)], "pr_number int, merged boolean, linked_issue_numbers array<long>")
    got = {s: sorted(r["pr_number"] for r in issues.requests_in_scope(prs, s).collect()) for s in ("all", "linked_only", "merged_only", "linked_or_merged")}
    assert got == {"all": [1, 2, 3, 4], "linked_only": [1, 3], "merged_only": [1, 2], "linked_or_merged": [1, 2, 3]}
    commits = spark.createDataFrame([("b", "2020"), ("a", "2020"), ("c", None)], "sha string, committed_at string")
    assert [r["sha"] for r in issues.commits_in_order(commits).collect()] == ["c", "a", "b"]
    fields = spark.createDataFrame([(" ", "t [IMAGE TEXT] x", "z")], "body string, clean_text string, text string").select(answers.context_field(["body", "clean_text", "text"]).alias("c")).first()["c"]
    assert (fields["field"], fields["text"]) == ("clean_text", "t x")
    assert one(spark, paths.series_folder(F.lit("a/By_Series/H7/x"))) == "H7"


def test_curated_cards(spark):
    lists = ("query_aliases", "confirmed_facts", "plausible_diagnosis", "likely_causes", "debug_checks", "possible_workarounds", "constraints_or_limits", "keywords")
    template = {"topic_id": "t", "applies_to": None, "title": "T", "symptom_summary": "S", "component": "I2C", "doc_url": "u"} | {k: [k] for k in lists}
    schema = "topic_id string, applies_to array<string>, title string, symptom_summary string, component string, doc_url string, " + ", ".join(f"{k} array<string>" for k in lists)
    templates = spark.createDataFrame([tuple(template.values()), *[("o", ["STM32F4"], *list(template.values())[2:])]], schema)
    repos = spark.createDataFrame([("STM32CubeH7",), ("STM32CubeC0",), ("stm32h7xx-hal",)], "repo string")
    got = diagnostic.curated(repos, templates).collect()
    assert [(r["id"], r["target_series"]) for r in got] == [("diag::STM32CubeH7::curated::t", ["STM32H7"])] and got[0]["st_ready_text"].count("\n") == 16


def test_semantic_lite_of_texts_without_tokens(spark):
    pairs = spark.createDataFrame([(1, "the timer works", "the timer works"), (2, "", "a b"), (3, "timer fails", None), (4, "spi bus", "the spi bus")], "k int, a string, b string")
    got = {r["k"]: r["semantic"] for r in similarity.semantic_lite(pairs, ["k"], "a", "b").collect()}
    assert got[1] == pytest.approx(1) and got[2] == 0 and got[3] == 0 and 0.7 < got[4] < 1


def test_workflow_runs():
    seen = []
    steps = [("Ingestion a", seen.append), ("Clean", seen.append), ("Broken", lambda s: 1 / 0), ("Last", seen.append)]
    out = workflow.run(steps, "x", skipped=("Ingestion",), on_error="continue")
    assert out.done == ["Clean", "Last"] and isinstance(out.failed["Broken"], ZeroDivisionError)
    with pytest.raises(ZeroDivisionError):
        workflow.run(steps, "x")
    both = workflow.run_series(["s1", "s2"], steps[:2])
    assert set(both) == {"s1", "s2"} and seen[-1] == "s2"
    assert workflow.run_phases(dict.fromkeys(("prepare", "gates", "upload"), lambda: None), "Prepare") == ["prepare", "gates"]
