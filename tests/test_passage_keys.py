"""Keys of long passages against plain loops, and the work they take."""

import random

import numpy as np
import pyarrow as pa
import pytest

from loomwright.operators import passages


def plain(words, hashes):
    """The distinct least run hashes of all windows of a row's words."""
    runs = [passages.least_of_windows(hashes[i : i + passages.SPAN]) for i in range(len(words) - passages.SPAN + 1)]
    return sorted({int(r[0]) for r in runs})


def hashes_of(words, piece=passages.PIECE):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    size = np.array([len(w.encode()) for w in words], np.int64)
    starts = np.cumsum(size + 1) - size - 1
    return passages.word_hashes(data, starts, starts + size, piece)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_keys_of_texts_are_those_of_each_text_alone(kind):
    rng = random.Random(2)
    rows = [[rng.choice(["ab", "ba", "é", "x1", "1x", "long-er", "z" * 40]) for _ in range(n)] for n in (0, 5, 11, 12, 13, 40, 0, 300, 12)] + [["again"] * 60, ["p", "q"] * 40]
    texts = pa.array([rng.choice(["", " ", "\n\t"]) + rng.choice([" ", "  "]).join(r) + rng.choice(["", " "]) for r in rows], kind)
    for column, want in ((texts, rows), (texts.slice(3, 6), rows[3:9])):
        batch = pa.record_batch([pa.array(range(len(want))), column], ["id", "whole"])
        got = [r for b in passages._text_keys(iter([batch])) for r in b.to_pylist()]
        assert [r["id"] for r in got] == list(range(len(want)))
        assert [sorted(np.array(r["keys"], np.int64).view(np.uint64).tolist()) for r in got] == [plain(r, hashes_of(r)) for r in want]


def test_words_hash_alike_in_any_piece_and_block():
    words = ["a", "b" * 50, "listen", "silent", "c" * 7, "listen"]
    whole = hashes_of(words)
    assert whole[2] == whole[5] and len(set(whole.tolist())) == 5
    assert all((hashes_of(words, piece) == whole).all() for piece in (1, 3, 8, 60))
    column = pa.array([" ".join(words * 4)] * 5 + [""])
    assert len({w.least[: passages.SPAN].tobytes() for block in (1, 10, 300, 1 << 20) for w in passages.windows(column, block) if len(w.least)}) == 1


def test_long_passages_with_white_space_at_their_edges(spark):
    for n in range(passages.SPAN - 1, passages.LONG + 2):
        inner = " ".join(f"p{i}" for i in range(n))
        for passage in (f" {inner}", f"{inner}\t", f" {inner} ", f"\x0b{inner}"):
            docs = spark.createDataFrame([("a", f"x{passage}y z"), ("b", f"u v{passage}w"), ("c", inner), (None, f"x{passage}")], "doc_id string, text string")
            assert sorted(str(r["doc_id"]) for r in passages.holding(docs, spark.createDataFrame([(passage,)], "text string")).collect()) == ["None", "a", "b"], (n, passage)


def test_no_run_of_a_text_is_hashed_word_by_word(spark):
    docs, wanted = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([("x y",)], "text string")
    plan = passages.holding(docs, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(slice(" not in plan and "MapInArrow" in plan
