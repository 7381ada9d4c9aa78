"""Fingerprints recomputed from texts in plain Python, and links between classes of equal fingerprints."""

import random
from itertools import combinations

import regex
import xxhash

from loomwright.llm import fingerprints as fp


def hashed(text):
    value = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return value - (1 << 64) if value >= 1 << 63 else value


def signatures(text):
    """The signatures of a text by a walk over its words."""
    plain = regex.sub(r"[^\p{L}\p{N}\n]+", " ", text.lower())
    # Line breaks with nothing between them are one, also at the end of a text.
    words = [fp.LINE, *regex.sub(r"\n[ \n]*", f" {fp.LINE} ", plain).split()]
    stops = {*fp.ANCHORS, fp.LINE}
    found = set()
    for at, word in enumerate(words):
        if word not in stops:
            continue
        chain, passed = [], 0
        for after in words[at + 1 :]:
            passed += after in stops
            if passed > fp.CHAIN or len(chain) == fp.CHAIN:
                break
            if after not in stops:
                chain.append(after)
        if chain or word != fp.LINE:
            found.add(hashed(" ".join([word, " ".join(chain)])))
        run = []
        for after in words[at + 1 :]:
            if after in stops:
                break
            run.append(after)
        if len(run) > fp.RUN:
            found |= {hashed(" ".join(run[i : i + fp.CHAIN + 1])) for i in range(len(run) - fp.CHAIN)}
    return sorted(found) if found or not text.strip() else [hashed(text)]


def test_fingerprints_equal_a_walk_over_the_words(spark):
    r = random.Random(9)
    vocabulary = "the of und la para house river Straße über niño 12 x9 don't mill; (tower) — blue green walk run tree".split()
    texts = ["", " ", "!!", "the", "the of a", "one", "\n\nthe\n\n", "a\n b\nc d e f g h i j k l m n o"]
    for _ in range(120):
        texts.append("".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", ", ", " \n\n "]) for _ in range(r.randrange(1, 60))))
    for _ in range(20):
        texts.append(" ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(5, 40))))
    rows = fp.with_signatures(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", "s").collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["s"] == signatures(row["text"]), row["text"]


def test_links_of_classes_against_all_pairs(spark):
    r = random.Random(2)
    common = list(range(10))  # signatures that every set holds
    base = [sorted(common + r.sample(range(100, 400), r.choice([1, 5, 20, 60]))) for _ in range(25)]
    sets = base + [sorted(set(s) - set(r.sample(s, max(1, len(s) // 12)))) for s in base] + [sorted({*s, 1000 + k}) for k, s in enumerate(base)]
    sets += base[:10] + [[] for _ in range(300)] + [[5], [5], [6]]
    ids = list(range(len(sets)))
    r.shuffle(ids)
    table = spark.createDataFrame([*zip(ids, sets), (None, [5])], "i long, s array<long>")
    first = {}
    for i, s in sorted(zip(ids, sets)):
        first.setdefault(tuple(s), i)
    assert {(g["id"], g["class_id"]) for g in fp.members(table, "i", "s").collect()} == {(i, first[tuple(s)]) for i, s in zip(ids, sets)}
    want = {}
    for (s, i), (t, j) in combinations(first.items(), 2):
        like = len({*s} & {*t}) / len({*s} | {*t})
        if like >= fp.NEAR:
            want[min(i, j), max(i, j)] = like
    got = fp.near_links(table, "i", "s").collect()
    assert len(want) > 30 and {(g["a"], g["b"]): g["likeness"] for g in got} == want and len(got) == len(want)
    assert fp.near_links(table.limit(0), "i", "s").count() == 0 and fp.members(table.where("i is null"), "i", "s").count() == 0
