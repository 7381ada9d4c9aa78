"""Documents that hold a passage, whole and anywhere in their text, by joins on keys of words.

A passage may begin and end inside a word, but the words between its first and its last stand whole in every text that
holds it. So passages fall in three classes:

* LONG words or more: the least hash of the first WINDOW runs of RUN inner words is the passage's key. In a text that holds the
  passage these runs stand side by side, so the least of that window is among the text's keys, which are the least hashes of all
  its windows. Neighbouring windows mostly share theirs, so a text has far fewer keys than words.
* from three words: the longest inner word is the key (ties: the least), against the text's words.
* one or two words: no word need stand whole, so these alone are looked for in every text.

Keys only propose; `contains` decides on the whole text and the whole passage. The keys of long passages and of texts are
computed in numpy, a block of rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from loomwright.functions.rules import text_of

#: Words in a run and runs in a window (a power of two); words in a window; the words of a passage that has a whole window inside.
RUN, WINDOW = 5, 8
SPAN = RUN + WINDOW - 1
LONG = SPAN + 2
#: Bytes of a block of rows, and of words that are hashed together.
BLOCK, PIECE = 1 << 21, 1 << 20
U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)


def words_of(text: Column) -> Column:
    return F.split(text, r"\s+")


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
    return z ^ (z >> U64(31))


with np.errstate(over="ignore"):
    VALUES = _mixed(np.arange(1, 257, dtype=U64) * ODD)
    #: A factor for each word of a run.
    PLACES = _mixed(np.arange(301, 301 + RUN, dtype=U64) * ODD) | U64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """A 64-bit hash of each word from the sums of its bytes' values and of these times their places, by running sums."""
    sums = np.zeros((2, len(starts)), U64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            a, j = int(starts[i]), int(np.searchsorted(ends, starts[i] + piece, "right"))
            if j <= i:  # a word longer than a piece
                j = i + 1
                for p in range(a, int(ends[i]), piece):
                    v = VALUES[data[p : min(p + piece, int(ends[i]))]]
                    sums[:, i] += np.array([v.sum(), (v * np.arange(p - a, p - a + len(v), dtype=U64)).sum()], U64)
            else:
                v = VALUES[data[a : ends[j - 1]]]
                s, e = starts[i:j] - a, ends[i:j] - a
                for k, values in enumerate((v, v * np.arange(len(v), dtype=U64))):
                    run = np.concatenate((np.zeros(1, U64), np.cumsum(values, dtype=U64)))
                    sums[k, i:j] = run[e] - run[s]
                sums[1, i:j] -= s.astype(U64) * sums[0, i:j]
            i = j
        return _mixed(sums[0] * ODD + sums[1])


@dataclass
class Windows:
    """Of the rows from first to last: the words before each row (one entry more), whether a row begins with white space,
    and the least hash of the window that begins at each word, also where it runs on into the next row."""

    first: int
    last: int
    before: np.ndarray
    spaced: np.ndarray
    least: np.ndarray


def windows(column: pa.Array, block: int = BLOCK) -> Iterator[Windows]:
    """Blocks of rows of a string column without nulls."""
    _, places, raw = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = min(max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, "right")) - 1), len(column))
        data, at = whole[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        ink = ~IS_SPACE[data]
        begins, finishes = ink.copy(), ink.copy()
        begins[1:] &= ~ink[:-1]
        finishes[:-1] &= ~ink[1:]
        full = at[1:] > at[:-1]
        begins[at[:-1][full]] = ink[at[:-1][full]]
        finishes[at[1:][full] - 1] = ink[at[1:][full] - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        spaced = np.zeros(last - first, bool)
        spaced[full] = ~ink[at[:-1][full]]
        yield Windows(first, last, np.searchsorted(starts, at), spaced, least_of_windows(word_hashes(data, starts, ends)))
        first = last


def least_of_windows(words: np.ndarray) -> np.ndarray:
    """The least hash of WINDOW runs of RUN words from each word on that has so many behind it."""
    if len(words) < SPAN:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        runs = sum(words[k : len(words) - RUN + 1 + k] * PLACES[k] for k in range(RUN))
        least, width = _mixed(runs), 1
    while width < WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return least


def _distinct(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without those that equal the one before."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return keys[new], row[new]


def _text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, distinct keys) of each (id, text)."""
    for b in batches:
        for w in windows(b.column(1)):
            n = np.diff(w.before)
            inside = np.arange(len(w.least)) + SPAN <= np.repeat(w.before[1:], n)[: len(w.least)]
            keys, row = w.least[inside], np.repeat(np.arange(len(n)), n)[: len(w.least)][inside]
            keys, row = _distinct(keys, row)  # mostly neighbours, so that less is sorted
            order = np.lexsort((keys, row))
            keys, row = _distinct(keys[order], row[order])
            offsets = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
            yield pa.record_batch([b.column(0)[w.first : w.last], pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64)))], ["id", "keys"])


def _passage_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(passage, key) of passages of LONG words or more: the window after the first word, which may be cut, or after white space."""
    for b in batches:
        for w in windows(b.column(0)):
            key = w.least[w.before[:-1] + ~w.spaced]
            yield pa.record_batch([b.column(0)[w.first : w.last], pa.array(key.view(np.int64))], ["passage", "key"])


def _long_candidates(whole: DataFrame, passages: DataFrame) -> DataFrame:
    keys = passages.where(F.size("words") >= LONG).select("passage").mapInArrow(_passage_keys, "passage string, key long")
    made = StructType([StructField("id", whole.schema["id"].dataType), StructField("keys", ArrayType(LongType()))])
    seen = whole.select("id", "whole").mapInArrow(_text_keys, made).select("id", F.explode("keys").alias("key"))
    return seen.join(keys, "key").select("id", "passage")


def _middle_candidates(docs: DataFrame, passages: DataFrame) -> DataFrame:
    some = passages.where((F.size("words") >= 3) & (F.size("words") < LONG))
    inner = F.slice("words", F.lit(2), F.size("words") - 2)
    ranked = F.array_sort(F.transform(inner, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    keys = some.select("passage", F.get(ranked, F.lit(0))["w"].alias("key"))
    seen = docs.select("id", F.explode(F.array_distinct("words")).alias("key"))
    return seen.join(keys, "key").select("id", "passage")


def holding(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage_col: str = "text") -> DataFrame:
    """The rows of docs whose text holds at least one passage. Case counts.

    Null texts and passages count as empty; an empty passage is in no text. Rows that share an id are looked at one by one, null ids
    are one id. Repeated passages count once. Columns of any other name stay as they are; only rows are taken away."""
    mark = "_passage"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    sought = passages.select(text_of(F.col(passage_col)).alias("passage")).where("passage <> ''").distinct().withColumn("words", words_of(F.col("passage")))
    whole = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("whole"))
    texts = whole.select("id", words_of(F.col("whole")).alias("words"))
    tiny = whole.join(sought.where(F.size("words") < 3), F.contains("whole", "passage")).select("id", "passage")
    proposed = _long_candidates(whole, sought).unionByName(_middle_candidates(texts, sought)).unionByName(tiny).distinct()
    found = proposed.select(F.col("id").alias(f"{mark}_id"), F.col("passage").alias(mark))
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(f"{mark}_id")) & F.contains(text_of(F.col(text_col)), F.col(mark)), "left_semi")
