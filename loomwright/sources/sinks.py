"""Writers: partitioned tables, wrapped JSON payloads, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partitioned(df: DataFrame, path: str, by: Sequence[str], kind: str = "parquet") -> None:
    """One folder for each key; keys that are written replace their folder, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(kind).save(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def wrapped(df: DataFrame, root: str, part: str) -> DataFrame:
    """(part, payload): {root: [records]} as JSON for each part; parts are bounded by the packing that made them."""
    record = F.struct(*(c for c in df.columns if c != part))
    return df.groupBy(part).agg(F.to_json(F.struct(F.collect_list(record).alias(root))).alias("payload"))


def manifest(df: DataFrame, part: str, text: str) -> DataFrame:
    """(part, docs, chars, kilobytes) of each part."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length(text)).alias("chars"), F.ceil(F.sum(size) / 1024).alias("kilobytes"))


def text_files(df: DataFrame, folder: str, name: str, text: str) -> None:
    """One file for each row, named by a column, written by the tasks that hold the rows."""
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    if "://" not in folder and not (conf or "").startswith("file"):
        raise ValueError("give the folder with its file system, such as file:/shared/cards")

    def write(rows) -> None:
        import pyarrow.fs as fs

        system, base = fs.FileSystem.from_uri(folder if ":" in folder else "file://" + folder)
        system.create_dir(base, recursive=True)
        for r in rows:
            with system.open_output_stream(f"{base}/{r[0]}") as out:
                out.write((r[1] or "").encode())

    df.select(name, text).foreachPartition(write)


def csv_file(df: DataFrame, path: str) -> None:
    """A table with a header; for summaries and manifests, which are small, in one part."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def markdown_table(df: DataFrame, columns: Sequence[str], title: str, order: Sequence[str] = ()) -> str:
    """A small summary as a Markdown table; values that are null stay blank."""
    rows = df.select(*columns).orderBy(*order).collect() if order else df.select(*columns).collect()
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "long", "integer", "decimal")}
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(columns), "|" + "|".join("---:" if c in numeric else "---" for c in columns) + "|", *map(line, rows)]) + "\n"


def mirrored(df: DataFrame, path: str, mirror: str, summary: DataFrame) -> None:
    """A payload by JSON lines, the same again at a second place, and its summary beside the first."""
    json_lines(df, path)
    df.sparkSession.read.schema(df.schema).json(path).write.mode("overwrite").json(mirror)
    json_lines(summary.coalesce(1), path.rstrip("/") + "_summary")


def run_artifacts(rows: DataFrame, manifest: dict, folder: str) -> None:
    """A run's manifest, its raw rows as JSON lines and its flat table."""
    from loomwright.operators.answers import flat_run

    spark = rows.sparkSession
    json_lines(spark.createDataFrame([manifest]).coalesce(1), f"{folder}/run_manifest")
    json_lines(rows, f"{folder}/responses_raw")
    csv_file(flat_run(rows), f"{folder}/responses_flat")
