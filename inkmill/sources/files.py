"""Documents that are files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.sniff import decoded
from inkmill.sources.tables import with_path_parts


FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _shaped(files: DataFrame) -> DataFrame:
    named = with_path_parts(files.select("path", F.col("length").alias("size"), "content"))
    return named.filter(~F.startswith("name", F.lit("."))).withColumn("text", decoded("content"))


def discover(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Files of a folder with their path parts, size, bytes and, where they are text, the decoded text.

    Hidden files are left out. Spark itself also leaves out names that start with an underscore; such files have to be
    brought in through a table. Bytes are read only by plans that use them.
    """
    return _shaped(spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder))


def discover_stream(spark: SparkSession, folder: str, recursive: bool = False, files_at_once: int | None = None) -> DataFrame:
    """The same as a stream: each file once, as it arrives, at most `files_at_once` in a micro-batch.

    The stream's checkpoint remembers which files it has seen; a file that is written again under its old name is not new.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", str(recursive).lower())
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return _shaped(reader.load(folder))


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown files, one row each, for stand-alone normalization or validation."""
    return spark.read.text(folder, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("text"),
    )
