"""Which documents still have to be converted.

Both operators work on narrow key columns, balance hot stems, and return their input with one more flag; no row is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.sources.staging import kept

SALTS = 32


def where(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by a result of long expressions. The row number keeps the filter above them; pushed below, it would repeat
    them many times over."""
    return df.withColumn("_row", F.monotonically_increasing_id()).filter(condition & (F.col("_row") >= 0)).drop("_row")


def first_of_stem(df: DataFrame) -> DataFrame:
    """Add `is_first`: the document has the lowest path among those with its stem.

    The lowest path per stem is a minimum, which is combined before the shuffle, so a stem held by a third of all rows
    costs one row per task. Winners are then matched by path, which is unique and therefore spreads evenly.
    """
    winners = df.groupBy("stem").agg(F.min("path").alias("path")).select("path", F.lit(True).alias("is_first"))
    return df.join(winners, "path", "left").withColumn("is_first", F.coalesce("is_first", F.lit(False)))


def flag_existing(df: DataFrame, existing: DataFrame, key: str = "path") -> DataFrame:
    """Add `has_output`: the key of the document occurs in `existing`.

    Paths are unique and need no care. Stems are not: the documents of one stem are spread over salted copies of the
    key, of which only the stems that are really present on both sides are made.
    """
    known = existing.select(key).distinct()
    if key == "path":
        flagged = df.join(known.withColumn("has_output", F.lit(True)), key, "left")
    else:
        shared = df.select(key).distinct().join(known, key, "left_semi")
        salted = shared.select(key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")).withColumn(
            "has_output", F.lit(True)
        )
        spread = F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")
        flagged = df.withColumn("_salt", spread).join(salted, [key, "_salt"], "left").drop("_salt")
    return flagged.withColumn("has_output", F.coalesce("has_output", F.lit(False)))


def split_keys(keys: DataFrame, existing: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """Paths of the documents with earlier output, and of all others, as two written tables.

    `keys` has path and, where that is the key, stem; nothing else of the documents takes part.
    """
    narrow = keys.select(*dict.fromkeys(["path", key])).distinct()
    flagged = kept(flag_existing(narrow, existing, key).select("path", "has_output"))
    return flagged.filter("has_output").select("path"), flagged.filter("NOT has_output").select("path")


def pending(df: DataFrame, existing: DataFrame, key: str = "path", force: bool = False) -> DataFrame:
    """Only the documents without output; `force` keeps all."""
    if force:
        return df
    if key == "path":
        return df.join(existing.select(key).distinct(), key, "left_anti")
    return flag_existing(df, existing, key).filter(~F.col("has_output")).drop("has_output")
