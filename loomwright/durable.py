"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """This application's part of spark.checkpoint.dir; a local folder only where that is unset on one machine, as in tests."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = sc._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it has to name a folder that the driver and all executors share")
        base = current.get() if current.isDefined() else "file://" + tempfile.mkdtemp(prefix="loomwright-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/loomwright-tables/{sc.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet into the shared folder and read again, so that lost executors cost nothing and its lineage ends.

    What the write shuffled is removed with it, so the disk holds one step's shuffles at a time."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}/{name}"
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def still_there(df: DataFrame) -> bool:
    """Whether the files that a stored frame reads are still in their folder."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return True
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0])
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path))
