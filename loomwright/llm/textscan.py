"""Vectorised scans over batches of text: word spans, word hashes, ragged gathers. All in numpy."""

from __future__ import annotations

import ctypes
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64


def released(run):
    """An Arrow function that gives the memory it no longer needs back to the system after each batch: workers are used
    again by later stages, and what an allocator keeps counts against the executor."""

    def wrapped(batches):
        try:
            for out in run(batches):
                yield out
                if out.num_rows > 1 << 10:
                    _give_back()
        finally:
            _give_back()

    return wrapped


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def splitmix(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers, the same on every machine."""
    with np.errstate(over="ignore"):
        z = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    return mixed(z)


def mixed(z: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


BYTE_VALUES = splitmix(256, 1)
STEP = U64(0xD6E8FEB86659FD93)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, STEP, U64), dtype=U64)


def within(lens: np.ndarray) -> np.ndarray:
    """0, 1, ... lens[0]-1, 0, 1, ... lens[1]-1, ..."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lens, lens)


def gathered(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs flat[starts[i] : starts[i] + lens[i]], one after another."""
    return flat[np.repeat(starts, lens) + within(lens)]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are not empty."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    pos = within(lens)
    longest = int(lens.max())
    with np.errstate(over="ignore"):
        terms = BYTE_VALUES[data[np.repeat(starts, lens) + pos]] * _powers(1 << max(8, longest.bit_length()))[pos]
        return mixed(np.add.reduceat(terms, np.cumsum(lens) - lens) + lens.astype(U64))


#: Bytes of a slice of words that are hashed together, and the number that undoes STEP.
SLICE, UNSTEP = 1 << 16, U64(pow(int(STEP), -1, 1 << 64))


@lru_cache(maxsize=1)
def _slice_powers() -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(SLICE, STEP, U64), dtype=U64), np.cumprod(np.concatenate((np.ones(1, U64), np.full(SLICE, UNSTEP, U64))), dtype=U64)


def hashes_with_tails(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """What span_hashes gives for rising spans and for the last bytes of each, tail at most. Both are differences of one
    running sum, from which the power of STEP at the span's beginning is taken out again."""
    tails = np.maximum(ends - tail, starts)
    out = np.empty((2, len(starts)), U64)
    up, down = _slice_powers()
    i = 0
    while i < len(starts):
        a, j = starts[i], int(np.searchsorted(ends, starts[i] + SLICE, "right"))
        if j <= i:  # longer than a slice
            j = i + 1
            out[0, i:j], out[1, i:j] = span_hashes(data, starts[i:j], ends[i:j]), span_hashes(data, tails[i:j], ends[i:j])
        else:
            part = data[a : ends[j - 1]]
            run = np.zeros(len(part) + 1, U64)
            with np.errstate(over="ignore"):
                np.cumsum(BYTE_VALUES[part] * up[: len(part)], out=run[1:])
                to = ends[i:j] - a
                last = run[to]
                for k, at in enumerate((starts[i:j] - a, tails[i:j] - a)):
                    out[k, i:j] = mixed((last - run[at]) * down[at] + (to - at).astype(U64))
        i = j
    return out[0], out[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls and the offsets of its rows, without copying."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int):
    """(first, last) row ranges of about limit bytes each, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space, and for each row the number of words before it."""
    ink = ~IS_SPACE[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    full = offsets[1:] > offsets[:-1]
    at, to = offsets[:-1][full], offsets[1:][full] - 1
    first[at] = ink[at]
    last[to] = ink[to]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, limit: int = 1 << 21):
    """For each block of rows of a string column: (first row, last row, hashes of the ASCII-lower-cased words,
    words before each row of the block). A row of any length is one block's; within it, hashing goes by slices of words."""
    data, offsets = buffers(column)
    for a, b in row_blocks(offsets, limit):
        part = data[offsets[a] : offsets[b]]
        starts, ends, before = word_spans(part, offsets[a : b + 1] - offsets[a])
        low = TO_LOWER[part]
        out = np.empty(len(starts), U64)
        for i in range(0, len(starts), 1 << 18):
            out[i : i + (1 << 18)] = span_hashes(low, starts[i : i + (1 << 18)], ends[i : i + (1 << 18)])
        yield a, b, out, before


class Table:
    """An open-addressing hash table from 64-bit keys to row numbers of value arrays, probed for whole arrays."""

    def __init__(self, slots: np.ndarray, rows: np.ndarray):
        self.slots, self.rows, self.shift, self.mask = slots, rows, U64(64 - int(len(slots)).bit_length() + 1), len(slots) - 1

    EMPTY = U64(0xFFFFFFFFFFFFFFFF)

    @classmethod
    def build(cls, keys: np.ndarray, spare: int = 4) -> Table:
        size = 1 << max(4, int(len(keys) * spare).bit_length())
        slots, rows = np.full(size, cls.EMPTY, U64), np.zeros(size, np.int32)
        table = cls(slots, rows)
        left, at = np.arange(len(keys)), table.place(keys)
        while len(left):
            free = slots[at] == cls.EMPTY
            # Of several keys at one slot the first takes it.
            taken, who = np.unique(at[free], return_index=True)
            mine = np.flatnonzero(free)[who]
            slots[taken], rows[taken] = keys[left[mine]], left[mine]
            rest = np.ones(len(left), bool)
            rest[mine] = False
            left, at = left[rest], (at[rest] + 1) & table.mask
        return table

    def place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for absent ones."""
        at = self.place(keys)
        got = self.slots[at]
        out = np.where(got == keys, self.rows[at], -1)
        left = np.flatnonzero((got != keys) & (got != self.EMPTY))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            got = self.slots[at]
            hit = got == keys[left]
            out[left[hit]] = self.rows[at[hit]]
            on = ~hit & (got != self.EMPTY)
            left, at = left[on], at[on]
        return out


#: Code point classes: 0 white space (and the mark between texts), 1 letters, 2 numbers, 3 others.
BETWEEN = 0xD800
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    kinds = {"L": 1, "N": 2}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(0x110000)), np.uint8, 0x110000)
    out[SPACES] = 0
    out[BETWEEN] = 0
    return out


@dataclass
class Words:
    """Words of a batch of texts: the bytes of the lower-cased texts, the spans of the words in them, and for
    each text the number of words before it (one entry more than texts)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    before: np.ndarray


def lower_words(texts: list[str]) -> Words:
    """Composed (NFC), lower-cased texts as runs of letters, single numbers, runs of other marks, and the
    English endings 's 't 're 've 'm 'll 'd where a run starts with their apostrophe."""
    joined = chr(BETWEEN).join(texts)
    if not unicodedata.is_normalized("NFC", joined):
        joined = chr(BETWEEN).join(unicodedata.normalize("NFC", t) for t in texts)
    low = joined.replace("Σ", "σ").lower()  # each letter by itself: no final sigma
    raw = low.encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, "<u4")
    data = np.frombuffer(low.encode("utf-8", "surrogatepass"), np.uint8)
    kind = classes()[points]
    first = kind != 0
    last = first.copy()
    change = kind[1:] != kind[:-1]
    number = kind == 2
    first[1:] &= change | number[1:]
    last[:-1] &= change | number[:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lone = np.flatnonzero((points[starts] == 39) & (ends - starts == 1))
    lone = lone[lone + 1 < len(starts)]
    lone = lone[(starts[lone + 1] == ends[lone]) & (kind[starts[lone + 1]] == 1)]
    if len(lone):
        p = ends[lone]
        one = points[p]
        two = points[np.minimum(p + 1, len(points) - 1)]
        take = np.isin(one, [115, 116, 109, 100]) + 2 * (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
        got = take > 0
        lone, take = lone[got], take[got]
        ends[lone] += take
        starts[lone + 1] += take
        some = ends > starts
        starts, ends = starts[some], ends[some]
    marks = np.flatnonzero(points == BETWEEN)
    before = np.concatenate(([0], np.searchsorted(starts, marks), [len(starts)]))
    if len(data) != len(points):
        size = (points >= 0x80).view(np.uint8) + (points >= 0x800).view(np.uint8) + (points >= 0x10000).view(np.uint8)
        at = np.ones(len(points) + 1, np.int64)
        at[0] = 0
        at[1:] += size
        np.cumsum(at, out=at)
        starts, ends = at[starts], at[ends]
    return Words(data, starts, ends, before)
