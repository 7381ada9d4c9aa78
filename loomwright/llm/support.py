"""What several operators need: input columns, the shared folder, durable tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts mean it, and its complement.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session.

    Only where that is unset on one machine, as in tests, a local folder is set; on a cluster that is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = sc._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it has to name a folder that the driver and all executors share")
        base = current.get() if current.isDefined() else "file://" + tempfile.mkdtemp(prefix="loomwright-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """The part of the shared folder that this application fills."""
    return f"{shared_dir(spark)}/loomwright/{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Remove the tables and files that this application has put into the shared folder. Results that are not yet read or written need them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """The frame cut from its lineage, in the shared folder, so that lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """As durable, but a compressed Parquet table with known size: for what is wide or read in part."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, data: bytes, stem: str) -> str:
    """Put bytes of bounded size into the shared folder and let Spark hand the file to every executor.

    Returns the name for SparkFiles.get, also valid on executors that join later.
    """
    name = f"{stem}-{uuid.uuid4().hex}.bin"
    uri = f"{own_dir(spark)}/{name}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at : at + (1 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(uri)
    return name


def local_file(name: str) -> str:
    """Where an executor (or the driver) has its copy of a published file."""
    return SparkFiles.get(name)
