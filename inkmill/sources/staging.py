"""Intermediate tables that live as long as a job needs them."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def staged(df: DataFrame, folder: str) -> Iterator[DataFrame]:
    """Write once to a folder all executors share, read back, and delete the folder at the end.

    Later reads touch only the columns they need, and lost executors lose nothing of it.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="inkmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it; a local session without one gets its own until it ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def kept(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back, for tables that outlive the call; lost executors lose nothing of it."""
    target = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
