"""Reports over the outcome of a run. All aggregates combine before the shuffle, so skewed groups do no harm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.selection import where


def status_counts(outcomes: DataFrame) -> DataFrame:
    """One row: total, success, failed, skipped. Whatever is neither success nor skipped counts as failed."""
    status = F.coalesce("status", F.lit(""))
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(status == "success").alias("success"),
        F.count_if(~status.isin("success", "skipped")).alias("failed"),
        F.count_if(status == "skipped").alias("skipped"),
    )


def details(outcomes: DataFrame) -> DataFrame:
    """File, status and error of every document."""
    return outcomes.select(F.col("name").alias("file"), "status", "error")


def failed_files(outcomes: DataFrame) -> DataFrame:
    """Failed documents with their error, sorted for reading. The path comes last, so that no group of equal names and errors
    is one sort key."""
    failed = where(outcomes, F.col("status") == "failed")
    return failed.select(F.col("name").alias("file"), "status", "error", "path").orderBy("file", "error", "path").drop("path")


def outcome_rates(outcomes: DataFrame) -> DataFrame:
    """Share of successes, of passed validations and of logged documents, per extension and mode."""
    done = where(outcomes, F.col("status") != "skipped")
    return done.groupBy("ext", "mode").agg(
        F.count("*").alias("documents"),
        F.avg((F.col("status") == "success").cast("int")).alias("success_rate"),
        F.avg(F.coalesce(F.col("validation.passed").cast("int"), F.lit(0))).alias("pass_rate"),
        F.avg(F.col("status").isNotNull().cast("int")).alias("log_rate"),
    )
