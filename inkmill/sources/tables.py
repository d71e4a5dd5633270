"""Documents that already sit in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import paths


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read the named columns of one parquet table."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(df: DataFrame, path: Column, text: Column, size: Column | None = None) -> DataFrame:
    """Bring any table into the shape the operators expect: path parts, text and size in bytes."""
    shaped = df.select(path.alias("path"), text.alias("text"), (F.octet_length(text) if size is None else size).cast("bigint").alias("size"))
    return with_path_parts(shaped)


def with_path_parts(df: DataFrame) -> DataFrame:
    name = F.col("name")
    return df.withColumn("name", paths.file_name(F.col("path"))).withColumns(
        {"stem": paths.stem(name), "suffix": paths.suffix(name), "ext": paths.extension(name)}
    )
