"""Output tables. Each run writes its own partition folder, so writing a run again replaces it, also by nothing, and history is
kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.audit import stamped
from inkmill.operators.escalation import attempt_rows, quarantine


def run_folder(target: str, run_id: str) -> str:
    return f"{target}/run_id={run_id}"


def _write_run(df: DataFrame, target: str, run_id: str, form: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if form == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(form).save(run_folder(target, run_id))


def write_raw(converted: DataFrame, target: str, run_id: str) -> None:
    """Extracted text, kept apart from clean text: whatever the last mode that gave text returned."""
    rows = converted.filter(F.col("raw_md").isNotNull()).select("path", "stem", "title", "raw_md")
    _write_run(rows, target, run_id)


def write_clean(converted: DataFrame, target: str, run_id: str) -> None:
    """Normalized text of the documents that passed."""
    rows = converted.filter(F.col("status") == "success").select("path", "stem", "title", "clean_md")
    _write_run(rows, target, run_id)


def write_quarantine(converted: DataFrame, target: str, run_id: str) -> None:
    _write_run(quarantine(converted), target, run_id)


def write_attempts(converted: DataFrame, target: str, run_id: str) -> None:
    """Every attempt of every document; `attempt_summary` folds them to what the log says."""
    _write_run(attempt_rows(converted), target, run_id)


def write_log(log: DataFrame, target: str, run_id: str) -> None:
    """Audit records as JSON lines, nulls included."""
    _write_run(stamped(log), target, run_id, "json")
