"""Try extraction modes in order until the quality checks pass.

All state of a document stays in its row: each mode of the chain is one more projection that does work only where the
document is at that mode. With column extractors the whole chain is a single stage without a shuffle, and a document
that passes early costs nothing later (CASE branches are evaluated on demand).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.normalize import normalize
from inkmill.functions.validate import RESULT_TYPE as VALIDATION_TYPE
from inkmill.functions.validate import validate
from inkmill.operators.extraction import Extractors, PythonExtractor, Unavailable
from inkmill.operators.routing import UNKNOWN, lookup, unsupported_reason
from inkmill.operators.selection import where
from inkmill.settings import Settings


ATTEMPT_TYPE = f"struct<attempt:int,mode:string,validation:{VALIDATION_TYPE},error:string>"
_STATE = ("try_mode", "escalated_to", "retry_count", "raw_md", "title", "clean_md", "validation", "last_error", "attempts")


def following(chain: tuple[str, ...]) -> dict[str, str]:
    """mode -> next mode. A mode listed twice counts where it stands first."""
    return {mode: chain[i + 1] for i, mode in enumerate(chain[:-1]) if chain.index(mode) == i}


def next_mode(mode: Column, settings: Settings = Settings()) -> Column:
    """Null at the end of the chain and for modes outside it."""
    return lookup(following(settings.modes.escalation_order()), mode)


def _begin(df: DataFrame) -> DataFrame:
    runs = (F.col("mode") != UNKNOWN) & ~F.col("skip")
    return df.withColumns(
        {
            "try_mode": F.when(runs, F.col("mode")),
            "escalated_to": F.lit(None).cast("string"),
            "retry_count": F.lit(0),
            "raw_md": F.lit(None).cast("string"),
            "title": F.lit(None).cast("string"),
            "clean_md": F.lit(None).cast("string"),
            "validation": F.lit(None).cast(VALIDATION_TYPE),
            "last_error": F.lit(None).cast("string"),
            "attempts": F.array().cast(f"array<{ATTEMPT_TYPE}>"),
        }
    )


def _with_attempt(active: Column, validation: Column, error: Column) -> Column:
    """The attempts so far and this one; its number is the number of moves before it."""
    made = F.struct(F.col("retry_count").alias("attempt"), F.col("try_mode").alias("mode"), validation.alias("validation"), error.alias("error"))
    return F.when(active, F.array_append("attempts", made.cast(ATTEMPT_TYPE))).otherwise(F.col("attempts"))


def _moved_on(fails: Column, active: Column, moved: Column) -> dict[str, Column]:
    retried = fails & moved.isNotNull()
    return {
        "try_mode": F.when(fails, moved).when(~active, F.col("try_mode")),
        "escalated_to": F.when(retried, moved).otherwise(F.col("escalated_to")),
        "retry_count": F.col("retry_count") + retried.cast("int"),
    }


def _attempt(
    df: DataFrame, active: Column, result: Column, moved: Column, cleaned: Column, judged: Column
) -> DataFrame:
    """One mode for the `active` documents: extract, normalize, validate, and move on those that fail."""
    kept = [c for c in df.columns if c not in _STATE]
    tried = df.withColumn("_x", F.when(active, result)).withColumn("_clean", cleaned).withColumn("_v", judged)
    fails = active & ~F.coalesce(F.col("_v.passed"), F.lit(False))
    has_text = F.col("_x.raw_md").isNotNull()
    after = {
        **_moved_on(fails, active, moved),
        "raw_md": F.when(has_text, F.col("_x.raw_md")).otherwise(F.col("raw_md")),
        "title": F.when(has_text, F.col("_x.title")).otherwise(F.col("title")),
        "clean_md": F.when(has_text, F.col("_clean")).otherwise(F.col("clean_md")),
        "validation": F.coalesce("_v", "validation"),
        "last_error": F.coalesce(F.col("_x.extract_error"), F.col("last_error")),
        "attempts": _with_attempt(active, F.col("_v"), F.col("_x.extract_error")),
    }
    return tried.select(*kept, *[after[name].alias(name) for name in _STATE])


def _refuse(df: DataFrame, active: Column, error: str, moved: Column) -> DataFrame:
    """A mode without an engine: only the error and the position in the chain change."""
    return df.withColumns(
        {
            **_moved_on(active, active, moved),
            "last_error": F.when(active, F.lit(error)).otherwise(F.col("last_error")),
            "attempts": _with_attempt(active, F.lit(None).cast(VALIDATION_TYPE), F.lit(error)),
        }
    )


def escalate(df: DataFrame, settings: Settings = Settings(), extractors: Extractors = Extractors()) -> DataFrame:
    """Convert routed documents (path, ext, size, text, mode, skip and whatever the extractors read).

    Adds the outcome of the last attempt: raw_md, title, clean_md, validation, last_error, retry_count, escalated_to; and all
    attempts, in order.
    """
    chain = settings.modes.escalation_order()
    if len(set(chain)) != len(chain):
        raise ValueError(f"a mode listed twice would be retried for ever: {chain}")
    off_chain = [m for m in extractors.registered if m not in chain]
    at = F.coalesce("try_mode", F.lit(""))
    # Modes outside the chain get one attempt; those nobody registered act as the standard mode.
    strays = (at != "") & ~at.isin(*chain, *off_chain)
    steps = [(at == mode, extractors.get(mode)) for mode in (*off_chain, *chain)]
    if "standard" in chain:
        place = len(off_chain) + chain.index("standard")
        steps[place] = ((at == "standard") | strays, extractors.get("standard"))
    else:
        steps.insert(0, (strays, extractors.get("")))

    # Built once, used by every step: the intermediate columns have the same names throughout.
    moved = next_mode(F.col("try_mode"), settings)
    cleaned = normalize("_x.raw_md", settings.normalization)
    judged = validate("_clean", "size", settings.validation)

    df = _begin(df)
    for active, extractor in steps:
        if isinstance(extractor, Unavailable):
            df = _refuse(df, active, extractor.error, moved)
        elif isinstance(extractor, PythonExtractor):
            df = _attempt(df, active, extractor(active), moved, cleaned, judged)
        else:
            df = _attempt(df, active, extractor(), moved, cleaned, judged)
    return df


def outcome(df: DataFrame) -> DataFrame:
    """Add status, failure_reasons and error to escalated documents; clean text is published only on success."""
    none = F.array().cast("array<string>")
    rejected = F.col("mode") == UNKNOWN
    reasons = F.concat(
        F.array_compact(F.array(F.nullif(F.col("last_error"), F.lit("")))),
        F.coalesce(F.col("validation.failure_reasons"), none),
    )
    status = (
        F.when(rejected, "failed")
        .when(F.col("skip"), "skipped")
        .when(F.col("validation.passed"), "success")
        .otherwise("failed")
    )
    with_status = df.withColumn("status", status)
    return with_status.withColumn(
        "failure_reasons",
        F.when(rejected, F.array(unsupported_reason(F.col("suffix")))).when(F.col("status") == "failed", reasons),
    ).withColumn("error", F.array_join("failure_reasons", "; "))


def attempt_rows(converted: DataFrame) -> DataFrame:
    """One row for each attempt: path, attempt, mode, validation, error. Documents that were skipped or rejected have none.

    A plain `inline` would have Spark test the array's size below the long expressions that make it, and so repeat them.
    """
    return converted.select("path", F.inline_outer("attempts")).filter(F.col("attempt").isNotNull())


def attempt_summary(attempts: DataFrame) -> DataFrame:
    """Fold an attempts table (path, attempt, mode, validation, error) to one row per document.

    The last validation and the last error survive later attempts that have none. Aggregates combine before the
    shuffle, and a path has at most as many rows as the chain has modes.
    """

    def last(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("attempt")))

    return attempts.groupBy("path").agg(
        F.min_by("mode", "attempt").alias("selected_mode"),
        F.when(F.max("attempt") > 0, F.max_by("mode", "attempt")).alias("escalated_to"),
        F.max("attempt").alias("retry_count"),
        last("validation").alias("validation"),
        last("error").alias("error"),
    )


def quarantine(converted: DataFrame) -> DataFrame:
    """Failed documents with their payload and reasons."""
    return where(converted, F.col("status") == "failed").select(
        F.col("name").alias("input_file"),
        "path",
        *[c for c in ("text", "content") if c in converted.columns],
        "clean_md",
        "failure_reasons",
        F.current_timestamp().alias("timestamp"),
    )
