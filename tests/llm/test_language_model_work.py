"""Work of the language model: hashes by running sums, exponentials once for each different word, sums of sorted rows."""

import math

import numpy as np
import pytest

from loomwright.llm import language_model as m
from loomwright.llm import textscan


def test_words_and_endings_hash_as_spans_do():
    r = np.random.default_rng(3)
    for text in (b"", b" ", b"a", b"  ab\tcde\n" * 9, b"x " * 50_000, b"y" * 70_000 + b" z", b"a " * 9 + b" " * 200_000 + b"end", b"q " + b"w" * (textscan.SLICE) + b" e", bytes(r.integers(0, 256, 300_000, dtype=np.uint8))):
        data = np.frombuffer(text, np.uint8)
        starts, ends, _ = textscan.word_spans(data, np.array([0, len(data)]))
        words, endings = textscan.hashes_with_tails(data, starts, ends, 3)
        assert (words == textscan.span_hashes(data, starts, ends)).all()
        assert (endings == textscan.span_hashes(data, np.maximum(ends - 3, starts), ends)).all()


@pytest.mark.parametrize("spread", [0.3, 3.0, 8.0])
def test_shares_from_factors_are_softmaxes_at_any_width(spread):
    r = np.random.default_rng(4)
    numbers = m.CLASSES + 40
    context = tuple(r.normal(0, spread, (numbers, m.WIDTH)).astype(np.float32) for _ in range(m.CONTEXT))
    out, bias = r.normal(0, 1, (m.CLASSES + 9, m.WIDTH)).astype(np.float32), r.normal(-5, 2, m.CLASSES + 9).astype(np.float32)
    rows = np.stack((r.integers(0, m.CLASSES, 1500), r.integers(0, numbers, 1500), r.integers(0, numbers, 1500)))
    got = m.log_probabilities(rows, context, out, bias, held=700)
    s = (context[0][rows[1]].astype(np.float64) + context[1][rows[2]]) @ out[: m.CLASSES].T.astype(np.float64) + bias[: m.CLASSES]
    top = s.max(1, keepdims=True)
    want = s[np.arange(1500), rows[0]] - top[:, 0] - np.log(np.exp(s - top).sum(1))
    near = want > -55  # a float32 sum knows no smaller shares
    assert near.sum() > 40 and got[near] * math.log(10) == pytest.approx(want[near], rel=1e-4, abs=1e-3)


def test_exponentials_are_taken_once_for_each_different_word(monkeypatch):
    taken, exp = [], np.exp
    monkeypatch.setattr(m.np, "exp", lambda x, *a, **k: (taken.append(np.size(x)), exp(x, *a, **k))[1])
    context, out, bias = m.unpacked(m.initial(np.full(m.CLASSES, 1 / m.CLASSES)))
    rows = np.random.default_rng(6).integers(0, 50, (3, 20_000))
    m.log_probabilities(rows, context, out, bias)
    assert sum(taken) <= 101 * m.CLASSES


def test_added_gradients_are_those_of_each_row():
    layout = m.Layout(np.arange(m.WORD_CLASSES).astype(np.uint64), np.full(m.WORD_CLASSES, 90), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 50, np.full(m.BUCKETS, 7.0))
    t, r = m.Trainer(layout), np.random.default_rng(8)
    rows, grads, before = r.integers(0, 40, 500), np.zeros((500, m.WIDTH + 2), np.float32), t.p.copy()
    grads[:, : m.WIDTH + 1] = r.normal(0, 1, (500, m.WIDTH + 1))
    t.add(rows, grads)
    for k in range(len(before)):
        g = grads[rows == k].astype(np.float64).sum(0)
        assert t.touches[k] == (rows == k).sum() and t.squares[k] == pytest.approx(m.PAST + g @ g / m.WIDTH, rel=1e-4)
        assert t.p[k] == pytest.approx(before[k] + m.RATE / math.sqrt(m.PAST + g @ g / m.WIDTH) * g, abs=1e-4)
    assert not t.p[:, m.WIDTH + 1].any()


def test_rows_are_added_in_their_order(monkeypatch):
    """Equal rows are summed first to last, by sorting numbers: no step sorts places."""
    layout = m.Layout(np.arange(m.WORD_CLASSES).astype(np.uint64), np.full(m.WORD_CLASSES, 90), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 50, np.full(m.BUCKETS, 7.0))
    t, r = m.Trainer(layout), np.random.default_rng(9)
    rows, grads, want = r.integers(0, 3, 900), np.zeros((900, m.WIDTH + 2), np.float32), t.p.copy()
    grads[:, : m.WIDTH + 1] = r.normal(0, 1, (900, m.WIDTH + 1))
    for k in range(3):
        g = np.add.reduceat(grads[rows == k], [0], axis=0)[0]
        want[k] += m.RATE / np.sqrt(np.float32(m.PAST) + np.einsum("i,i->", g, g) / m.WIDTH) * g
    monkeypatch.setattr(m.np, "argsort", None)
    t.add(rows, grads)
    assert t.p == pytest.approx(want, abs=1e-6)
