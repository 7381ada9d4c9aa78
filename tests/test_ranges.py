"""Numbers, halves and greedy parts over ranges against loops, with hot keys, ties, nulls and empty tables."""

import random
from collections import defaultdict

import pytest
from loomwright.operators import ranges, windows
from pyspark.sql import functions as F

SCHEMA = "k string, id long, s long, _rows int, part string"


def rows(seed, n=900):
    r = random.Random(seed)
    found = [(r.choice(["hot"] * 6 + ["a", "b", None]), r.randrange(10**6) if r.random() > 0.02 else None, r.choice([0, 1, 3, 7, 20, None])) for _ in range(n)]
    return [(k, i, s, 1, "x") for k, i, s in found] + [("one", 1, 100, 1, "x")]


def by_key(given):
    groups = defaultdict(list)
    for k, i, s, *_ in given:
        groups[k].append((i is not None, i or 0, s or 0))
    return {k: sorted(g) for k, g in groups.items()}


def test_numbers_and_running_sums(spark):
    given = rows(1)
    df = spark.createDataFrame(given, SCHEMA).repartition(5)
    out = ranges.running(df, ["k"], ["id"], {"number": F.lit(1), "before": F.col("s")}, [F.coalesce("s", F.lit(0))]).collect()
    assert len(out) == len(given)
    want = by_key(given)
    for k, group in want.items():
        got = sorted(((r["number"], r["before"], r["id"], r["s"] or 0) for r in out if r["k"] == k))
        assert [g[0] for g in got] == list(range(len(group)))
        total = 0
        for g, (known, i, s) in zip(got, group, strict=True):
            assert g[1:] == (total, i if known else None, s)
            total += s
    assert ranges.numbered(df.limit(0), [], ["id"]).count() == 0
    assert sorted(r["number"] for r in ranges.numbered(df, [], ["id"]).collect()) == list(range(len(given)))


def test_equal_rows_have_their_own_numbers(spark):
    df = spark.range(500).select(F.lit("k").alias("k"), F.lit(1).alias("id"))
    assert sorted(r["number"] for r in ranges.numbered(df, ["k"], ["id"]).collect()) == list(range(500))


@pytest.mark.parametrize(("n", "parts"), [(7, 3), (2, 5), (12, 4), (1, 1)])
def test_even_parts_are_ntile(spark, n, parts):
    df = spark.range(n).select(F.lit(1).alias("k"), "id")
    from pyspark.sql import Window

    want = [r[0] for r in df.select(F.ntile(parts).over(Window.orderBy("id")).alias("p"), "id").orderBy("id").collect()]
    assert [r["part"] for r in windows.even_parts(df, ["id"], parts, ["k"]).orderBy("id").collect()] == want
    assert [r["part"] for r in windows.even_parts(df, ["id"], parts).orderBy("id").collect()] == want


def halved(sizes, most):
    out, number = [], 0

    def cut(lo, hi):
        nonlocal number
        if sum(sizes[lo:hi]) > most and hi - lo > 1:
            mid = lo + (hi - lo) // 2
            cut(lo, mid)
            cut(mid, hi)
        else:
            out.extend([number] * (hi - lo))
            number += 1

    cut(0, len(sizes))
    return out


@pytest.mark.parametrize("most", [0, 5, 60, 10**6])
def test_halves_equal_the_recursion(spark, most):
    given = rows(2, 300)
    df = spark.createDataFrame([(k, n, s, 1, "x") for n, (k, _, s, *_) in enumerate(given)], SCHEMA).repartition(3)
    out = defaultdict(dict)
    for r in ranges.halves(df, ["k"], ["id"], F.col("s"), most, "sub").collect():
        out[r["k"]][r["id"]] = (r["s"], r["sub"])
    for group in out.values():
        ordered = [group[i] for i in sorted(group)]
        assert [sub for _, sub in ordered] == halved([s or 0 for s, _ in ordered], most)
    assert ranges.halves(df.limit(0), ["k"], ["id"], F.col("s"), most, "sub").count() == 0


def greedy(sizes, most_rows, most_size):
    out, part, n, held = [], 0, 0, 0
    for at, s in enumerate(sizes):
        if at and (n + 1 > most_rows or held + s > most_size):
            part, n, held = part + 1, 0, 0
        n, held = n + 1, held + s
        out.append(part)
    return out


@pytest.mark.parametrize(("most_rows", "most_size", "block"), [(4, 20, 16), (1, 5, 7), (50, 10**6, 8), (10**6, 40, 16), (10**6, 10**6, 32), (8, 0, 16)])
def test_greedy_parts_of_a_large_key(spark, most_rows, most_size, block, monkeypatch):
    """A key over many tasks has the parts of the loop; parts may span several blocks."""
    real = ranges.greedy_starts
    monkeypatch.setattr(ranges, "greedy_starts", lambda placed, keys, a, b: real(placed, keys, a, b, block))
    given = [(k, n, s, 1, "x") for n, (k, _, s, *_) in enumerate(rows(most_rows, 200))]
    df = spark.createDataFrame(given, SCHEMA).repartition(3)
    out = defaultdict(dict)
    for r in windows.greedy_parts(df, ["k"], "id", F.col("s"), most_rows, most_size, alone=30).collect():
        out[r["k"]][r["id"]] = (r["size"], r["part"])
    assert sum(map(len, out.values())) == len(given)
    for group in out.values():
        ordered = [group[i] for i in sorted(group)]
        assert [p for _, p in ordered] == greedy([s for s, _ in ordered], most_rows, most_size)


def test_greedy_parts_of_a_table_without_keys(spark, monkeypatch):
    real = ranges.greedy_starts
    monkeypatch.setattr(ranges, "greedy_starts", lambda placed, keys, a, b: real(placed, keys, a, b, 9))
    df = spark.range(100).select("id", (F.col("id") % 7).alias("s"))
    got = windows.greedy_parts(df, [], "id", F.col("s"), 5, 12, alone=10).orderBy("id").collect()
    assert [r["part"] for r in got] == greedy([i % 7 for i in range(100)], 5, 12)
