"""Helpers the corpus operators share: written intermediate tables and row keys."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="inkmill-llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write once and read back: cuts the lineage, and lost executors lose nothing of it."""
    target = scratch(df.sparkSession)
    df.write.parquet(target)
    table = df.sparkSession.read.schema(df.schema).parquet(target)
    table.saved_at = target
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more: what was made of them has been written."""
    for table in tables:
        if target := getattr(table, "saved_at", None):
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(target)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The given columns beside the whole input row as one struct `row`, so that no input name can clash with ours."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[c.alias(n) for n, c in columns.items()])
