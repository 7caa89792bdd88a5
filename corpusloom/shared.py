"""The folder that driver and executors share, and files in it through Spark's own file systems."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; a folder of our own only where it is unset and driver and executors are one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that they share")
        root = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than cores dealt out to all of them; others are left as they are.

    A Parquet file of one row group is one task, however many cores wait. Large tables have many files: no shuffle there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def file_system(spark: SparkSession, path: str):
    """The path as Spark's file systems know it, and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame made by ``written`` once nothing reads it any more."""
    spark = df.sparkSession
    root = shared_root(spark)
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/" + path.split(":", 1)[-1].lstrip("/") == "/" + root.split(":", 1)[-1].lstrip("/"):
            continue
        hadoop, files = file_system(spark, path)
        files.delete(hadoop, True)


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file with the given content."""
    hadoop, files = file_system(spark, path)
    out = files.create(hadoop, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
