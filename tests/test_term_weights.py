"""Weights of a row a document against counting in Python, with repeated and missing ids, and what travels for them."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from loomwright.durable import stored
from loomwright.operators import similarity, term_weights
from pyspark.sql import functions as F

SCHEMA = "block string, id long, text string"


def rows(seed=3, n=200):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(70)]
    found = [(r.choice(["a", "b", "b", None]), i, " ".join(r.choices(words, k=r.randrange(0, 12)) + [f"own{i}"])) for i in range(n)]
    return found + [("a", 3, "w1 w2 again"), ("b", 3, "w1 w1"), ("a", None, "w5 nameless"), ("a", None, "w5 w6"), ("b", 900, None), ("b", 901, "!"), ("a", 902, "w1 w2 w1")]


def by_hand(found, most=None):
    docs, sizes = defaultdict(Counter), Counter()
    for block, i, text in found:
        sizes[block] += 1
        docs[block, i].update(t for t in (text or "").split() if len(t) > 1)
    df, total = defaultdict(Counter), defaultdict(Counter)
    for (block, _), c in docs.items():
        df[block].update(c.keys())
        total[block].update(c)
    out = {}
    for (block, i), c in docs.items():
        known = set(sorted(df[block], key=lambda t: (-total[block][t], t))[: most or len(df[block])])
        v = [(df[block][t], n * (math.log((1 + sizes[block]) / (1 + df[block][t])) + 1)) for t, n in c.items() if t in known]
        norm = math.sqrt(sum(w * w for _, w in v))
        if v and block is not None and i is not None:
            out[block, i] = sum(n == 1 for n, _ in v), sorted(w / norm for _, w in v)
    return out


@pytest.mark.parametrize(("entries", "most"), [(2_000_000, None), (20, None), (0, None), (2_000_000, 15), (12, 15), (2_000_000, 60)])
def test_weights_equal_counting_by_hand(spark, monkeypatch, entries, most):
    monkeypatch.setattr(term_weights, "ENTRIES", entries)
    monkeypatch.setattr(term_weights, "GROUP", 30)
    table = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = {(r["block"], r["id"]): (r["singles"], sorted(r["w"])) for r in similarity.weights(table, "block", "id", "text", most_terms=most).collect() if r["w"]}
    want = by_hand(rows(), most)
    assert got.keys() == want.keys()
    assert all(got[x][0] == want[x][0] and got[x][1] == pytest.approx(want[x][1], abs=1e-12) for x in want)


def test_texts_and_counts_do_not_travel(spark):
    table = stored(spark.createDataFrame([r for r in rows() if r[1] not in (3, None)], SCHEMA), "texts")
    plan = similarity.weights(table, "block", "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange hash" not in plan


def test_a_written_step_leaves_no_shuffle(spark):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {name for f in files.split(",") if (name := f.rsplit("/", 1)[-1]).startswith("shuffle_")}

    before = shuffles()
    written = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    stored(written, "sums")
    for _ in range(20):
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before
