"""Memory of a worker that encodes: texts become strings a run at a time, and what is not needed goes back to the system."""

import os
import subprocess
import sys

import pyarrow as pa

from loomwright.llm import bpe

#: Counts and encodes a batch of 24 MB as a worker does; prints the MB of its own memory held then beyond those before.
WORKER = """
import gc, re, sys
import numpy as np, pyarrow as pa
from types import SimpleNamespace
from unittest import mock
from loomwright.llm import bpe, textscan

def held():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

class Frame:
    schema, sparkSession, found = {"id": SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))}, None, []
    def mapInArrow(self, run, kind):
        self.found.append(run)
        return self
    def collect(self):
        return []
    def __getattr__(self, name):
        return lambda *a, **k: self

with mock.patch.object(bpe, "F"), mock.patch.object(bpe, "whole_text"), mock.patch.object(bpe, "encoder", lambda *a: coder):
    bpe.frequent_words(Frame())
    bpe.round_trip(Frame(), lexicon="none", with_ids=True)
coder = bpe.Encoder(bpe.vocabulary(bpe.default_vocabulary()), None)
textscan.classes()
bpe.encoder = lambda *a: coder
r = np.random.default_rng(1)
words = np.array(["".join(chr(97 + x) for x in r.integers(0, 26, r.integers(2, 9))) for _ in range(20000)])
texts = [" ".join(words[r.integers(0, 20000, 500)]) for _ in range(8000)]
column = pa.array(texts)
del texts
gc.collect()
textscan._give_back()
before, rows = held(), 0
for run, columns in zip(Frame.found, ([column], [pa.array(range(8000)), column])):
    for out in run(iter([pa.record_batch(columns, ["id", "text"][-len(columns):])])):
        rows += out.num_rows
del out
print(held() - before, rows)
"""


def test_a_worker_gives_its_memory_back():
    got = subprocess.run([sys.executable, "-c", WORKER], capture_output=True, text=True, check=True, env=os.environ | {"OMP_NUM_THREADS": "1"}).stdout.split()
    assert float(got[0]) < 60 and int(got[1]) > 8000


def test_runs_of_a_column_are_bounded_and_whole():
    texts = ["", "a", "é" * 40, "x" * 300, "", "end"] * 7
    column = pa.array(["cut off", *texts])[1:]
    found = list(bpe.runs(column, 100))
    assert [t for _, run in found for t in run] == texts
    assert [at for at, _ in found] == [sum(len(run) for _, run in found[:k]) for k in range(len(found))]
    assert all(len(run) == 1 or sum(len(t.encode()) for t in run) <= 100 for _, run in found)
    assert list(bpe.runs(column[:0], 100)) == []


def test_rows_of_a_column_are_encoded_as_texts():
    coder = bpe.Encoder(bpe.vocabulary(bpe.default_vocabulary()), None)
    texts = ["", "one two", "<|endoftext|> x", "Größe don't 12", "y " * 700_000, "tail"]
    want = [ids[a:b].tolist() for first, last, ids, bounds in coder.encoded(texts) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    got = [(first, ids[a:b].tolist()) for first, last, ids, bounds in coder.encoded_rows(pa.array(texts)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [ids for _, ids in got] == want and got[-1][0] <= 5
    ids = coder.batch([texts[3] * 9000])[0]
    assert coder.vocab.spelled(ids).tobytes() == b"".join(coder.vocab.spelled(ids[k : k + 1000]).tobytes() for k in range(0, len(ids), 1000))
