"""What the pipeline's stages do with repeated ids, null ids, clashing names, empty tables, and a mix whose edge has one time."""

from collections import Counter

import corpus_pipeline
import pytest
from loomwright.llm import mixing, ngram_join
from pyspark.sql import functions as F

from .test_operators import words

A = " ".join(f"a{i}" for i in range(100))
NEAR = A + " more"
B = " ".join(f"b{i}" for i in range(100))
C = " ".join(f"c{i}" for i in range(100))
NAMES = ("_passes", "_pass", "_id", "passes", "key", "row", "other", "sha", "n", "node", "root", "none", "first", "slot", "at", "size", "id")


def given(spark, rows):
    return spark.createDataFrame([(*r, *range(len(NAMES))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in NAMES)).repartition(3)


def kept(out):
    return Counter((r["doc_id"], r["text"]) for r in out.collect())


def test_rows_of_one_id_stay_or_go_by_their_text(spark):
    rows = [(3, A), (5, NEAR), (5, B), (7, C), (7, C), (8, None), (8, None), (9, ""), (None, B), (None, "x y z"), (None, NEAR), (11, "one two"), (12, "one two")]
    docs = given(spark, [(*r, "en", "s", 1) for r in rows])
    out = ngram_join.kept_of_groups(docs)
    assert out.columns == docs.columns
    assert kept(out) == Counter([(3, A), (5, B), (7, C), (8, None), (8, None), (9, ""), (None, "x y z"), (11, "one two")])


def test_one_row_of_a_group_without_ids(spark):
    docs = given(spark, [(None, t, "en", "s", 1) for t in (A, NEAR, A, B, None)])
    out = kept(ngram_join.kept_of_groups(docs))
    assert sum(out.values()) == 3 and out[None, B] == 1 and out[None, None] == 1


def test_mixed_keeps_columns_of_any_name(spark):
    docs = given(spark, [(i, f"w{i} x y", "en", f"s{i % 3}", i) for i in range(30)] + [(None, "z z", "en", None, 1)])
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(tuple(r)[5:] == tuple(range(len(NAMES))) for r in rows)
    taken = {r["doc_id"]: r["passes_taken"] for r in mixing.mixture(docs).collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter({i: n for i, n in taken.items() if n})


@pytest.mark.parametrize("edge", [1, 7, 1 << 16])
def test_budget_ends_among_rows_of_one_time(spark, monkeypatch, edge):
    """Sources of one document share their finish times; the cut there is that of one global order, however small the last range is."""
    monkeypatch.setattr(mixing, "EDGE", edge)
    rows = [(i, " ".join(["w"] * (1 + i % 3)), f"s{i:04}") for i in range(300)] + [(1000 + i, "a b c d", "big") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mix = mixing.Mix()
    timed = mixing.mixture(docs, mix).collect()
    goal = {r["doc_id"]: (r["target"], r["source_size"]) for r in timed}
    import hashlib

    total, at, source = Counter(), [], {i: s for i, _, s in rows}
    size = {i: len(words(t)) for i, t, _ in rows}
    for key, i in sorted((hashlib.md5(f"mix:{i}".encode()).hexdigest(), i) for i in size):
        total[source[i]] += size[i]
        at += [((goal[i][1] * p + total[source[i]]) / goal[i][0], key, str(i), p, i) for p in range(2)]
    left, want = 1.5 * sum(size.values()), Counter()
    for *_, i in sorted(at):
        left -= size[i]
        if left < 0:
            break
        want[i] += 1
    assert {r["doc_id"]: r["taken"] for r in timed} == {i: want[i] * size[i] for i in size}


def test_pipeline_on_odd_tables(spark, tmp_path):
    r = [(i, t, "en" if i else None, s, 1) for i, t, s in ((1, A, "s"), (2, NEAR, "s"), (3, None, None), (3, B, "t"), (None, C, "t"), (None, C, "t"), (4, "", "u"), (4, "", "u"), (5, "x " * 5000, None))]
    spark.createDataFrame([(i, 1, 0) for i in (1, 3)] + [(2, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    given(spark, r).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert out.count() == docs.count() > 0
    given(spark, []).write.mode("overwrite").parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").where(F.lit(True)).count() == 0
