"""The conversion job: route, skip what is done, convert with escalation, write, report."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.paths import file_name
from inkmill.operators.audit import conversion_log
from inkmill.operators.escalation import escalate, outcome
from inkmill.operators.extraction import Extractors
from inkmill.operators.report import details, failed_files, status_counts
from inkmill.operators.routing import UNKNOWN, route
from inkmill.operators.membership import marked
from inkmill.operators.selection import SALTS, split_keys
from inkmill.settings import Settings
from inkmill.sinks import tables as sinks
from inkmill.sources.staging import kept, staged


def attempted(
    docs: DataFrame,
    settings: Settings = Settings(),
    extractors: Extractors = Extractors(),
    existing: DataFrame | None = None,
    force: bool = False,
    forced_mode: str | None = None,
    key: str = "path",
) -> DataFrame:
    """Outcome of every document whose key has no earlier output; those with one are skipped."""
    routed = route(docs, settings.modes, forced_mode)
    if force or existing is None:
        decided = routed.withColumn("skip", F.lit(False))
    else:
        # Decided on keys alone; the documents are read again with the answer, and never shuffled.
        decided = marked(routed, *split_keys(docs, existing, key), "path", "skip")
    # Documents nobody can route are reported as such, whatever was written before.
    skip = F.col("skip") & (F.col("mode") != UNKNOWN)
    return outcome(escalate(decided.withColumn("skip", skip), settings, extractors))


def late_paths(done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths of the documents whose stem's output belongs to a lower path that gave text, and of all others, as written tables.

    The lowest path of a stem is a minimum, combined before the shuffle. Documents are matched with it by stem and a salt, so a stem
    that holds a third of all documents is spread over many tasks; stems of one document are left out first.
    """
    rows = kept(done.select("path", "stem", (~F.col("skip") & (F.col("mode") != UNKNOWN)).alias("named"), F.col("raw_md").isNotNull().alias("text")))
    lowest = F.min(F.when(F.col("text"), F.col("path")))
    holders = rows.groupBy("stem").agg(lowest.alias("holder"), F.count("*").alias("n")).filter("n > 1 AND holder IS NOT NULL")
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = holders.select("stem", "holder", F.explode(salts).alias("salt"))
    named = rows.filter("named").withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    late = kept(named.join(salted, ["stem", "salt"]).filter(F.col("path") > F.col("holder")).select("path").distinct())
    return late, rows.select("path").distinct().join(late, "path", "left_anti")


def one_per_stem(done: DataFrame) -> DataFrame:
    """Documents of a stem share an output: the lowest path that gave text has it, and those after it are skipped.

    Documents before it have failed without text and stay failed. Who comes too late is decided on key columns; the documents
    themselves are not shuffled. `done` is read several times, so it should be a written table.
    """
    marks = marked(done, *late_paths(done), "path", "late")
    empty = {c: F.when(~F.col("late"), F.col(c)) for c in _GIVEN}
    return marks.withColumns(
        {
            **empty,
            "retry_count": F.when(F.col("late"), 0).otherwise(F.col("retry_count")),
            "skip": F.col("late") | F.col("skip"),
            "status": F.when(F.col("late"), "skipped").otherwise(F.col("status")),
        }
    ).drop("late")


_GIVEN = ("escalated_to", "raw_md", "title", "clean_md", "validation", "last_error", "failure_reasons", "error", "attempts")


def convert(
    docs: DataFrame,
    settings: Settings = Settings(),
    extractors: Extractors = Extractors(),
    existing: DataFrame | None = None,
    force: bool = False,
    forced_mode: str | None = None,
    key: str = "path",
) -> DataFrame:
    """Outcome of every document, one row each, in one pass.

    `existing` holds the keys (`path` or `stem`) of earlier raw output; which documents have one is found at once, on keys alone. With
    `key="stem"` documents share an output name with all others of their stem, unless forced; which one gets it is known
    after the attempts (see `one_per_stem`), so the attempts are written to the shared folder first.
    """
    done = attempted(docs, settings, extractors, existing, force, forced_mode, key)
    return one_per_stem(kept(done)) if key == "stem" and not force else done


@dataclass(frozen=True)
class Run:
    run_id: str
    summary: DataFrame
    failures: DataFrame
    details: DataFrame


class BatchFailed(RuntimeError):
    """Raised after everything is written when the settings say that a failed document fails the batch."""


def earlier_output(spark: SparkSession, target: str, key: str, run_id: str) -> DataFrame | None:
    """Keys of raw output written by other runs, or None before the first one. A run that is repeated ignores itself."""
    try:
        return spark.read.schema(f"{key} string, run_id string").parquet(f"{target}/raw").filter(F.col("run_id") != run_id).select(key)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_batch(
    docs: DataFrame,
    target: str,
    settings: Settings = Settings(),
    extractors: Extractors = Extractors(),
    force: bool = False,
    forced_mode: str | None = None,
    key: str = "path",
    run_id: str | None = None,
) -> Run:
    """Convert `docs` and write raw, clean, failed, attempts and logs tables below `target`.

    The outcome is staged once, below `target`, and every table reads only its own columns of it; it is deleted when all are
    written. The reports read the log.
    """
    spark = docs.sparkSession
    run_id = run_id or uuid.uuid4().hex
    started = time.monotonic()
    existing = None if force else earlier_output(spark, target, key, run_id)
    done = attempted(docs, settings, extractors, existing, force, forced_mode, key)
    # The input itself is needed again only for the documents that go to quarantine.
    payload = [c for c in ("text", "content") if c in done.columns]
    failed = F.col("status") == "failed"
    with staged(done.withColumns({c: F.when(failed, F.col(c)) for c in payload}), f"{target}/staging/{run_id}") as held:
        result = one_per_stem(held) if key == "stem" and not force else held
        sinks.write_raw(result, f"{target}/raw", run_id)
        sinks.write_clean(result, f"{target}/clean", run_id)
        sinks.write_quarantine(result, f"{target}/failed", run_id)
        sinks.write_attempts(result, f"{target}/attempts", run_id)
        log = conversion_log(
            result, F.lit(f"{target}/raw"), F.lit(f"{target}/clean"), round(time.monotonic() - started, 3)
        )
        sinks.write_log(log, f"{target}/logs", run_id)

    log_schema = "input_file string, status string, error string"
    logged = spark.read.schema(log_schema).json(sinks.run_folder(f"{target}/logs", run_id)).withColumnRenamed("input_file", "path")
    logged = logged.withColumn("name", file_name(F.col("path")))
    run = Run(run_id, status_counts(logged), failed_files(logged), details(logged))
    if not settings.batch.continue_on_error:
        worst = logged.filter(F.col("status") == "failed").agg(F.min_by(F.struct("path", "error"), "path").alias("f")).first().f
        if worst is not None:
            raise BatchFailed(f"{worst.path}: {worst.error}")
    return run
