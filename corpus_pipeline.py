"""A corpus from raw documents: quality rules, line dedup, near-duplicate join, source mixing, encoding.

Each stage works on all rows its predecessor kept, is written as Parquet and read again. All but the last return the columns
of documents; the mix repeats a row as often as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import bpe, jaccard, lines, mixing, rules
from inkmill.llm.common import saved

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Of the pieces that the encoding may remember: its workers still hold what the stages before it needed.
REMEMBERED_SHARE = 1 / 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    return rules.passing(docs, rules.STRICT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with two others or more, but for the one with the largest id."""
    return lines.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near copies."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each document, and the hash of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    done = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN, REMEMBERED_SHARE), path)
    return done.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("encoding", encoding),
]

#: The hash of the near-duplicate stage's sets and the encoding have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
