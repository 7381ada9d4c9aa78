"""Files of a given name as a Data Source writer: written beside the target by each attempt, and moved into it when the job commits.

A file is seen whole or not at all: a failed, repeated or speculative attempt leaves nothing behind, and a job that fails leaves the
files of the one before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def _system(folder: str):
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


@dataclass
class Written(WriterCommitMessage):
    """What an attempt has written: its folder, and the names of the files in it."""

    folder: str
    names: list[str]


class FilesWriter(DataSourceWriter):
    """Rows (name, text), those of one name together. layout `array`: the texts of a name are JSON values of one array; `text`: a row is a file.

    A file is written as its rows come, so memory does not grow with it."""

    def __init__(self, folder: str, layout: str):
        if layout not in ("array", "text"):
            raise ValueError(f"layout {layout}: array or text")
        self.folder, self.layout = folder.rstrip("/"), layout
        self.job = f"{self.folder}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        system, base = _system(f"{self.job}/{uuid.uuid4().hex}")
        system.create_dir(base, recursive=True)
        names: list[str] = []
        out = None
        try:
            for name, text in iterator:
                if not name or "/" in name or name.startswith(("_", ".")):
                    raise ValueError(f"not a file name: {name}")
                again = bool(names) and names[-1] == name
                if not again:
                    if name in names:
                        raise ValueError(f"rows of {name} do not stand together")
                    if out:
                        self._end(out)
                    out = system.open_output_stream(f"{base}/{name}")
                    names.append(name)
                elif self.layout == "text":
                    raise ValueError(f"two rows are named {name}")
                if self.layout == "array":
                    out.write(b",\n" if again else b"[\n")
                out.write((text or ("null" if self.layout == "array" else "")).encode())
        finally:
            if out:
                self._end(out)
        return Written(base, names)

    def _end(self, out) -> None:
        if self.layout == "array":
            out.write(b"\n]\n")
        out.close()

    def commit(self, messages: list[Written | None]) -> None:
        """Move the files of the attempts that count; one name from two of them is an error, and nothing is moved."""
        system, base = _system(self.folder)
        done = [m for m in messages if m is not None]
        every = [n for m in done for n in m.names]
        if len(every) != len(set(every)):
            self.abort(messages)
            raise ValueError("files of one name were written by two tasks")
        for m in done:
            for name in m.names:
                system.move(f"{m.folder}/{name}", f"{base}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, base = _system(self.job)
        import pyarrow.fs as fs

        if system.get_file_info(base).type == fs.FileType.Directory:
            system.delete_dir(base)


class CommittedFiles(DataSource):
    """df.write.format("committed_files").mode("append").option("layout", "array").save(folder), of columns (name, text)."""

    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        if [f.name for f in schema.fields] != ["name", "text"]:
            raise ValueError("columns are name and text")
        return FilesWriter(self.options["path"], self.options.get("layout", "array"))


def save_files(rows: DataFrame, folder: str, layout: str) -> None:
    """Rows (name, text) as files. A file of an array is one task's, so it is as long as its rows; names are dealt out by hash."""
    spark = rows.sparkSession
    spark.dataSource.register(CommittedFiles)
    dealt = rows.select("name", "text").repartition("name").sortWithinPartitions("name", "text") if layout == "array" else rows.select("name", "text")
    dealt.write.format("committed_files").mode("append").option("layout", layout).save(folder)


def json_array_files(df: DataFrame, folder: str, key: str) -> None:
    """One file for each key, <key>.json, with an array of its rows as objects, in the order of their text. A null key is left out with its rows."""
    record = F.to_json(F.struct(*(F.col(c) for c in df.columns)))
    name = F.concat(F.regexp_replace(F.col(key).cast("string"), "[^A-Za-z0-9.-]", "_"), F.lit(".json"))
    save_files(df.where(F.col(key).isNotNull()).select(name.alias("name"), record.alias("text")), folder, "array")


def card_files(df: DataFrame, folder: str, name: str, text: str, manifest: list[str]) -> None:
    """One Markdown file for each row, and manifest.csv with the file name and some columns of each, written once the files are there."""
    save_files(df.select(F.col(name).alias("name"), F.col(text).alias("text")), folder, "text")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    lines = df.select(F.lit("part").alias("part"), F.concat_ws(",", *(quoted(c) for c in [name, *manifest])).alias("line"), F.col(name).alias("at"))
    head = df.sparkSession.createDataFrame([("part", ",".join([name, *manifest]), "")], "part string, line string, at string")
    ordered = head.unionByName(lines).repartition("part").sortWithinPartitions("at")
    spark = df.sparkSession
    spark.dataSource.register(Manifest)
    ordered.select("line").write.format("committed_manifest").mode("append").save(folder)


class ManifestWriter(FilesWriter):
    """Lines in order as one file, from the task that has any."""

    def __init__(self, folder: str):
        super().__init__(folder, "text")

    def write(self, iterator: Iterator) -> Written:
        system, base = _system(f"{self.job}/{uuid.uuid4().hex}")
        system.create_dir(base, recursive=True)
        names: list[str] = []
        out = None
        try:
            for (line,) in iterator:
                if out is None:
                    out = system.open_output_stream(f"{base}/manifest.csv")
                    names.append("manifest.csv")
                out.write((line + "\n").encode())
        finally:
            if out:
                out.close()
        return Written(base, names)


class Manifest(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_manifest"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options["path"])


def read_arrays(spark, folder: str, schema: str) -> DataFrame:
    """The rows of json_array_files again, with the file's name."""
    from loomwright.sources.readers import json_arrays

    return json_arrays(spark, f"{folder.rstrip('/')}/*.json", schema).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))

