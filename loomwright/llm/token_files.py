"""Token ids in Arrow files: equal-length sequences and masks, read in place.

Documents are dealt out by ranges of doc_id; each range becomes one Arrow file whose record batches hold
fixed-size lists: a sequence of `length` ids of 16 bits and a mask of what is real. Sequences run across
documents and batches, so the i-th id of a file lies at a known place and is read without copying from a
mapped file. Beside it an index file holds each document's start and length. Files lie in the shared
folder, are written under a task's own name and then renamed, so a task that runs again leaves the same.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import default_vocabulary, encoder, lexicon_for
from .support import documents, durable, own_dir, whole_text
from .textscan import released

#: Ids in a sequence, sequences in a record batch, and the id that ends a document.
LENGTH, SEQUENCES, END = 2048, 256, 2


def layout(length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", pa.uint16(), False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])


def file_name(part: int, kind: str) -> str:
    return f"part-{part:06d}.{kind}.arrow"


class SequenceWriter:
    """Ids in, record batches of fixed-size lists out; what is left at the end is padded and masked."""

    def __init__(self, sink, length: int, sequences: int):
        self.schema, self.length, self.room = layout(length), length, length * sequences
        self.file = pa.ipc.new_file(sink, self.schema)
        self.held, self.size = [], 0

    def add(self, ids: np.ndarray) -> None:
        while len(ids):
            take = min(len(ids), self.room - self.size)
            self.held.append(ids[:take])
            self.size += take
            ids = ids[take:]
            if self.size == self.room:
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.size // self.length)
        flat = np.zeros(rows * self.length, np.uint16)
        mask = np.zeros(rows * self.length, bool)
        if self.size:
            flat[: self.size] = np.concatenate(self.held)
            mask[: self.size] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema, strict=True)]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._flush()
        self.file.close()


class SequenceFile:
    """Random access to a file of sequences. On a local or mounted path the file is mapped and nothing is copied."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.room = None if not self.file.num_record_batches else self.file.get_batch(0).num_rows * self.length

    def batch(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of record batch i, sequences by length; the ids are a view."""
        b = self.file.get_batch(i)
        ids = b.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids.reshape(-1, self.length), b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, self.length)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence i of the file and its mask."""
        at, row = divmod(i, self.room // self.length)
        ids, mask = self.batch(at)
        return ids[row], mask[row]

    def runs(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from place start on, as views of the batches that hold them."""
        while n > 0:
            at, inside = divmod(start, self.room)
            flat = self.file.get_batch(at).column(0).flatten().to_numpy(zero_copy_only=True)
            run = flat[inside : inside + n]
            yield run
            start, n = start + len(run), n - len(run)


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def write(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END, lexicon: str | None = None, files: int | None = None) -> tuple[str, DataFrame]:
    """Write all ids in ascending id order (null ids first, rows with one id by text); (folder, part table).

    The part table has a row for each file: part, docs, n_tokens and start, the number of ids in the files before.
    """
    spark = docs.sparkSession
    path = path or default_vocabulary()
    lexicon = lexicon or lexicon_for(docs, text_col, path)
    folder = f"{own_dir(spark)}/{uuid.uuid4().hex}/tokens"
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    # Bounds by id alone: the sample that Spark takes for them holds no texts.
    ranged = rows.repartitionByRange(files, "id") if files else rows.repartitionByRange("id")
    parts = ranged.sortWithinPartitions("id", "text").mapInArrow(released(partial(_write_part, folder, path, lexicon, length, end)), "part int, docs long, n_tokens long")
    parts = durable(parts)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return folder, parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _write_part(folder: str, path: str, lexicon: str, length: int, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder, task = encoder(path, lexicon), TaskContext.get()
    fs, base = opened(folder)
    fs.create_dir(base, recursive=True)
    own = f".{task.taskAttemptId()}-{uuid.uuid4().hex}"
    names = [f"{base}/{file_name(task.partitionId(), kind)}" for kind in ("ids", "index")]
    total = docs = 0
    with fs.open_output_stream(names[0] + own) as sink, fs.open_output_stream(names[1] + own) as index_sink:
        writer = SequenceWriter(sink, length, SEQUENCES)
        index = None
        for b in batches:
            for first, last, ids, bounds in coder.encoded_rows(b.column(1)):
                ended = np.insert(ids.astype(np.uint16), bounds[1:], end)
                writer.add(ended)
                sizes = np.diff(bounds) + 1
                starts = total + np.cumsum(sizes) - sizes
                rows = pa.record_batch([b.column(0)[first:last], pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], ["id", "start", "n_tokens"])
                index = index or pa.ipc.new_file(index_sink, rows.schema)
                index.write_batch(rows)
                total += len(ended)
                docs += last - first
        writer.close()
        if index:
            index.close()
    if docs:
        for name in names:
            fs.move(name + own, name)
        yield pa.record_batch([pa.array([task.partitionId()], pa.int32()), pa.array([docs], pa.int64()), pa.array([total], pa.int64())], ["part", "docs", "n_tokens"])
    else:
        for name in names:
            fs.delete_file(name + own)


def _read_parts(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fs, base = opened(folder)
    for b in batches:
        for part, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            sequences = SequenceFile(fs, f"{base}/{file_name(part, 'ids')}")
            index = pa.ipc.open_file(fs.open_input_file(f"{base}/{file_name(part, 'index')}"))
            for i in range(index.num_record_batches):
                rows = index.get_batch(i)
                sums = []
                for s, n in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                    crc = 0
                    for run in sequences.runs(s, n):
                        crc = zlib.crc32(run.astype("<u4"), crc)
                    sums.append(crc)
                starts = pa.array(np.asarray(rows.column(1)) + start, pa.int64())
                yield pa.record_batch([rows.column(0), starts, rows.column(2), pa.array(sums, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])


def read(folder: str, parts: DataFrame, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) for each document, from the files: start counts the ids of all documents before it."""
    spark = parts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parts.select("part", "start").repartition(n, "part").mapInArrow(partial(_read_parts, folder), f"id {id_type}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def token_files(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """Write and read back: one row for each row of docs.

    Null and empty texts have the end id alone. Ties in id are ordered by text; repeated rows are written each.
    Only id and text are read; an empty table gives no files and no rows. Texts are encoded by the lexicon and
    merges of bpe.py, which give the ids of the tokenizers library (tests hold them together): the library alone
    took 1426 CPU seconds for a GB of input where these took 500 on the same machine.
    """
    folder, parts = write(docs, path, id_col, text_col, length, end)
    return read(folder, parts, docs.schema[id_col].dataType.simpleString(), id_col)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))
