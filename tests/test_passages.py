import random

from loomwright.operators import passages


def brute(docs, wanted):
    return sorted((k for k, t in docs if any(p and p in (t or "") for p in wanted)), key=str)


def test_long_middle_and_tiny_passages_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "größer", "¿qué"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "  ", " \t"]) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 3, 12, 30, 200]))) for i in range(150)] + [(900, None), (901, ""), (None, "unseen phrase of a row without id")]
    cut = []
    for _ in range(60):
        whole = rng.choice(docs[:150])[1]
        at = rng.randrange(len(whole) + 1)
        cut.append(whole[at : at + rng.choice([2, 9, 25, 60, 400])])
    for wanted in (cut[:1], cut[:20], cut, [c for c in cut if len(c) > 80], ["", None, "nowhere at all"], ["phrase of a"], ["seen phrase of a row wit"], []):
        table = spark.createDataFrame([(p,) for p in wanted], "text string")
        got = passages.holding(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()
        assert sorted((r["doc_id"] for r in got), key=str) == brute(docs, wanted), wanted


def test_edges_inside_words_at_the_bounds_of_the_classes(spark):
    for n in (1, 2, 3, 4, passages.LONG - 1, passages.LONG, passages.LONG + 1, 60):
        passage = " ".join(f"p{i}" for i in range(n))
        docs = [(1, f"before x{passage}y after"), (2, passage.replace("p0", "p_0")), (3, passage), (4, passage.replace(" ", "  ") if n > 1 else "p"), (5, "a " * 40 + passage)]
        got = passages.holding(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(passage,)], "text string")).collect()
        assert sorted(r["doc_id"] for r in got) == [1, 3, 5], n


def test_repeated_ids_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three four", "a", 1), (1, "none", "b", 2), (1, "one two three four", "c", 3)], "doc_id long, text string, _passage string, id int")
    wanted = spark.createDataFrame([("two three f",), ("two three f",)], "text string")
    got = passages.holding(docs, wanted)
    assert got.columns == docs.columns and sorted(r["_passage"] for r in got.collect()) == ["a", "c"]
    assert passages.holding(docs.limit(0), wanted).count() == 0
