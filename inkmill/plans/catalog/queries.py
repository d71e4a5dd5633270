"""The queries: each takes a session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import html, markup, normalize as N, paths, references, sniff, validate as V
from inkmill.operators import audit, report
from inkmill.operators.escalation import attempt_rows as made_attempts, attempt_summary, escalate, next_mode, outcome, quarantine
from inkmill.operators.extraction import Extractors, extract, extracted, standard
from inkmill.operators.routing import (
    TYPE_MODES,
    UNKNOWN,
    detected_type,
    lookup,
    mode_by_extension,
    mode_by_override,
    route,
    unsupported_reason,
)
from inkmill.operators.selection import first_of_stem, pending, where
from inkmill.plans.catalog import inputs
from inkmill.plans.convert import convert
from inkmill.settings import Modes
from inkmill.sources.staging import kept

Query = Callable[[SparkSession, str], DataFrame]


def _joined(reasons: Column) -> Column:
    return F.array_join(reasons, "; ")


def _flat_validation(v: str) -> list[Column]:
    return [
        F.col(f"{v}.passed").alias("passed"),
        F.col(f"{v}.char_count").alias("char_count"),
        F.col(f"{v}.heading_count").alias("heading_count"),
        F.col(f"{v}.repetition_flag").alias("repetition_flag"),
        F.round(f"{v}.extraction_ratio", 6).alias("extraction_ratio"),
        _joined(F.col(f"{v}.failure_reasons")).alias("failure_reasons"),
        _joined(F.col(f"{v}.warnings")).alias("warnings"),
    ]


# sources and selection


def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    name = paths.file_name(F.col("path"))
    return inputs.files(spark, sf).select(
        "path",
        name.alias("name"),
        paths.stem(name).alias("stem"),
        paths.suffix(name).alias("suffix"),
        paths.extension(name).alias("ext"),
        "size",
    )


def stem_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return first_of_stem(inputs.files(spark, sf).select("path", "stem")).select("path", "stem", "is_first")


def skip_existing(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.files(spark, sf).select("path", "stem")
    return pending(files, inputs.converted_before(spark, sf), "path").select("path", "stem")


def skip_existing_stem(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.files(spark, sf).select("path", "stem")
    return pending(files, inputs.converted_before(spark, sf), "stem").select("path", "stem")


# routing


def route_ext(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.files(spark, sf).select("path", "ext", mode_by_extension(F.col("ext")).alias("mode"))


def route_override(spark: SparkSession, sf: str) -> DataFrame:
    modes = Modes(extension_overrides=inputs.OVERRIDES)
    return inputs.files(spark, sf).select("path", "ext", mode_by_override(F.col("ext"), modes).alias("mode"))


def sniff_mime(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.files(spark, sf)
    typed = files.select("path", detected_type(files).alias("mime"))
    return typed.withColumn("mode", lookup(TYPE_MODES, F.col("mime")))


def sniff_bytes(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.byte_files(spark, sf)
    return files.select("page_id", F.octet_length("content").alias("size"), sniff.binary_type("content").alias("mime"))


def sniff_packages(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.packages(spark, sf).select("page_id", "cut", sniff.binary_type("content").alias("mime"))


def route_all(spark: SparkSession, sf: str) -> DataFrame:
    return route(inputs.files(spark, sf), Modes(extension_overrides=inputs.OVERRIDES)).select("path", "mode")


def route_unknown(spark: SparkSession, sf: str) -> DataFrame:
    routed = route(inputs.files(spark, sf)).filter(F.col("mode") == UNKNOWN)
    return routed.select("path", F.lit("failed").alias("status"), unsupported_reason(F.col("suffix")).alias("error"))


# extraction


def extract_standard(spark: SparkSession, sf: str) -> DataFrame:
    files = extract(inputs.files(spark, sf), standard)
    return files.select("path", "raw_md", "title", "extract_error")


def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.document_files(spark, sf)
    return extract(docs, standard).select("path", "raw_md", "title")


def extract_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.tier_files(spark, sf)
    return pages.select("path", html.html_to_markdown("text").alias("raw_md"))


def extract_html_structure(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.structured_pages(spark, sf)
    return pages.select("conv_id", "turn", html.html_to_markdown("text").alias("raw_md"))


def decode_references(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.referenced_texts(spark, sf).select("doc_id", references.decode_references("text").alias("out"))


def decode_text(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.encoded_files(spark, sf)
    return files.select("doc_id", sniff.charset("content").alias("charset"), sniff.decoded("content").alias("out"))


def extract_title(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.tier_files(spark, sf).select("path", html.html_title("text").alias("title"))


def extract_csv(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.csv_files(spark, sf)
    return files.select("conv_id", "turn", markup.csv_to_markdown(F.col("text")).alias("raw_md"))


def ocr_lines_to_md(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.ocr_files(spark, sf)
    return files.select("conv_id", "turn", markup.ocr_to_markdown(F.col("ocr")).alias("raw_md"))


def extract_errors(spark: SparkSession, sf: str) -> DataFrame:
    routed = route(inputs.files(spark, sf))
    modes = Extractors()
    error = F.lit(None).cast("string")
    for mode in ("standard", "paddle_ocr"):
        error = F.coalesce(error, F.when(F.col("mode") == mode, modes.get(mode)()["extract_error"]))
    return routed.select("path", "mode", error.alias("error"))


# normalization, step by step on the same Markdown


def _step(function: Callable[[str], Column]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return inputs.markdown(spark, sf).select("conv_id", "turn", function("raw").alias("out"))

    return query


def protect_code(spark: SparkSession, sf: str) -> DataFrame:
    md = inputs.markdown(spark, sf).withColumn("blocks", N.code_blocks("raw"))
    return md.select("conv_id", "turn", N.protect_code("raw", "blocks").alias("out"))


def restore_code(spark: SparkSession, sf: str) -> DataFrame:
    md = inputs.markdown(spark, sf).withColumn("blocks", N.code_blocks("raw"))
    # What happens to the text in between must not reach the blocks; tokens hold no space.
    changed = md.withColumn("hidden", F.replace(N.protect_code("raw", "blocks"), F.lit(" "), F.lit("_")))
    return changed.select("conv_id", "turn", N.restore_code("hidden", "blocks").alias("out"))


def normalize_all(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.texts(spark, sf).select("doc_id", N.normalize("text").alias("clean_md"))


# validation


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.markdown(spark, sf).select("conv_id", "turn", "size", N.normalize("raw").alias("clean_md"))


def char_count(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.texts(spark, sf).select("doc_id", V.char_count("text").alias("char_count"))


def heading_count(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.markdown(spark, sf).select("conv_id", "turn", V.heading_count("raw").alias("heading_count"))


def line_runs(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.texts(spark, sf).select("doc_id", V.repeated_lines("text").alias("flag"))


def substring_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.texts(spark, sf).select("doc_id", V.repeated_inside_line("text").alias("flag"))


def repetition_flag(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.texts(spark, sf).select("doc_id", V.repetition_flag("text").alias("flag"))


def extraction_ratio(spark: SparkSession, sf: str) -> DataFrame:
    size = F.when(F.col("turn") % 5 != 0, F.when(F.col("turn") % 3 == 0, 0).otherwise(F.col("size")))
    sized = inputs.markdown(spark, sf).withColumn("size", size)
    return sized.select("conv_id", "turn", F.round(V.extraction_ratio("raw", "size"), 6).alias("ratio"))


def validate_empty(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.files(spark, sf)
    judged = files.withColumn("v", V.validate("text", "size"))
    return judged.select(
        "path", "v.passed", "v.char_count", "v.extraction_ratio", _joined(F.col("v.failure_reasons")).alias("reasons"),
        F.size("v.warnings").alias("n_warnings"),
    )


def validate_short(spark: SparkSession, sf: str) -> DataFrame:
    judged = inputs.texts(spark, sf).withColumn("v", V.validate("text", "cast(NULL AS bigint)"))
    short = F.filter("v.failure_reasons", lambda r: F.startswith(r, F.lit("char_count")))
    return judged.select("doc_id", F.get(short, F.lit(0)).alias("reason"))


def validate_warnings(spark: SparkSession, sf: str) -> DataFrame:
    judged = _cleaned(spark, sf).withColumn("v", V.validate("clean_md", "size"))
    return judged.select("conv_id", "turn", _joined(F.col("v.warnings")).alias("warnings"))


def validate_all(spark: SparkSession, sf: str) -> DataFrame:
    clean = inputs.texts(spark, sf).select("doc_id", "size", N.normalize("text").alias("clean_md"))
    judged = clean.withColumn("v", V.validate("clean_md", "size"))
    return judged.select("doc_id", *_flat_validation("v"))


def validate_markdown(spark: SparkSession, sf: str) -> DataFrame:
    judged = _cleaned(spark, sf).withColumn("v", V.validate("clean_md", "size"))
    return judged.select("conv_id", "turn", *_flat_validation("v"))


# escalation


def _tiers(spark: SparkSession, sf: str) -> DataFrame:
    return outcome(escalate(inputs.tier_files(spark, sf), inputs.tier_settings(), inputs.tier_extractors()))


def next_modes(spark: SparkSession, sf: str) -> DataFrame:
    routed = route(inputs.files(spark, sf), Modes(extension_overrides=inputs.OVERRIDES))
    return routed.select("path", "mode", next_mode(F.col("mode")).alias("next_mode"))


def escalated(spark: SparkSession, sf: str) -> DataFrame:
    return _tiers(spark, sf).select(
        "path", "status", F.col("mode").alias("selected_mode"), "escalated_to", "retry_count", "raw_md", "clean_md", "error"
    )


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Every mode from the first one on, as a table: the attempts of a document that never passes."""
    chain, settings = inputs.tier_settings().modes.escalation_order(), inputs.tier_settings()
    tried = F.array(
        *[
            F.struct(F.lit(i).alias("at"), F.lit(mode).alias("mode"), result.alias("x"))
            for i, (mode, result) in enumerate(inputs.tier_modes().items())
        ]
    )
    first = F.array_position(F.array(*map(F.lit, chain)), F.col("mode")).cast("int") - 1
    rows = inputs.tier_files(spark, sf).select("path", "size", first.alias("first"), F.explode(tried).alias("t"))
    rows = rows.filter(F.col("t.at") >= F.col("first"))
    judged = rows.withColumn("clean_md", N.normalize("t.x.raw_md", settings.normalization))
    return judged.select(
        "path",
        (F.col("t.at") - F.col("first")).alias("attempt"),
        "t.mode",
        V.validate("clean_md", "size", settings.validation).alias("validation"),
        F.col("t.x.extract_error").alias("error"),
    )


def attempt_rows(spark: SparkSession, sf: str) -> DataFrame:
    summary = attempt_summary(attempts(spark, sf))
    return summary.select(
        "path", "selected_mode", "escalated_to", "retry_count", F.col("validation.char_count").alias("char_count"),
        _joined(F.col("validation.failure_reasons")).alias("reasons"), "error",
    )


def attempts_made(spark: SparkSession, sf: str) -> DataFrame:
    """The attempts that a run writes: those after the first success are not made."""
    made = made_attempts(_tiers(spark, sf))
    reasons = _joined(F.col("validation.failure_reasons")).alias("reasons")
    return made.select("path", "attempt", "mode", "validation.passed", "validation.char_count", reasons, "error")


def failed_docs(spark: SparkSession, sf: str) -> DataFrame:
    failures = where(_tiers(spark, sf), F.col("status") == "failed")
    return failures.select(
        "path", F.size("failure_reasons").alias("n_reasons"), "error", F.col("raw_md").isNotNull().alias("has_raw")
    )


def quarantined(spark: SparkSession, sf: str) -> DataFrame:
    kept = quarantine(_tiers(spark, sf))
    return kept.select(
        "input_file", F.length("text").alias("payload_length"), F.length("clean_md").alias("clean_length"),
        _joined(F.col("failure_reasons")).alias("failure_reasons"),
    )


# audit log and reports


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return audit.conversion_log(_tiers(spark, sf), duration_seconds=1.23456)


def conversion_log(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    plain = [c for c in log.columns if c not in ("validation", "engine_version")]
    return log.select(*plain, *_flat_validation("validation"))


def log_json(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf).drop("engine_version")
    rounded = log.withColumn(
        "validation", F.col("validation").dropFields("extraction_ratio")
    )
    return audit.as_json(rounded)


def convert_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: every document routed, converted, checked and logged."""
    done = convert(inputs.document_files(spark, sf))
    return done.select(
        "path", F.col("mode").alias("selected_mode"), "status", "retry_count", "error",
        F.col("validation.char_count").alias("char_count"), F.md5("raw_md").alias("raw_md5"),
        F.md5("clean_md").alias("clean_md5"),
    )


def convert_files(spark: SparkSession, sf: str) -> DataFrame:
    """Mixed formats, overrides, shared stems, earlier output: the same run on files."""
    done = convert(
        inputs.files(spark, sf), existing=inputs.converted_before(spark, sf).select("stem"), key="stem"
    )
    return done.select("path", F.col("mode").alias("selected_mode"), "status", "escalated_to", "retry_count", "error")


def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.status_counts(convert_files(spark, sf))


def document_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.status_counts(convert(inputs.document_files(spark, sf)))


def batch_failed(spark: SparkSession, sf: str) -> DataFrame:
    done = convert(inputs.document_files(spark, sf))
    # Sorting by range looks at its input twice; the conversion runs once.
    return report.failed_files(kept(where(done, F.col("status") == "failed").select("name", "status", "error", "path")))


def outcome_rates(spark: SparkSession, sf: str) -> DataFrame:
    rates = report.outcome_rates(convert(inputs.files(spark, sf)))
    return rates.select(
        "ext", "mode", "documents", *[F.round(c, 6).alias(c) for c in ("success_rate", "pass_rate", "log_rate")]
    )


QUERIES: dict[str, Query] = {
    "path_parts": path_parts,
    "stem_dedup": stem_dedup,
    "skip_existing": skip_existing,
    "skip_existing_stem": skip_existing_stem,
    "route_ext": route_ext,
    "route_override": route_override,
    "sniff_mime": sniff_mime,
    "sniff_bytes": sniff_bytes,
    "sniff_packages": sniff_packages,
    "route": route_all,
    "route_unknown": route_unknown,
    "extract_standard": extract_standard,
    "extract_text": extract_text,
    "extract_html": extract_html,
    "extract_html_structure": extract_html_structure,
    "extract_title": extract_title,
    "decode_references": decode_references,
    "decode_text": decode_text,
    "extract_csv": extract_csv,
    "ocr_lines_to_md": ocr_lines_to_md,
    "extract_errors": extract_errors,
    "protect_code": protect_code,
    "strip_trailing": _step(N.strip_trailing),
    "collapse_blank": _step(N.collapse_newlines),
    "unify_bullets": _step(N.unify_bullets),
    "drop_empty_headings": _step(N.drop_empty_headings),
    "collapse_repeats": _step(N.collapse_repeats),
    "strip_doc": _step(N.strip_document),
    "restore_code": restore_code,
    "normalize_all": normalize_all,
    "normalize_markdown": _step(N.normalize),
    "char_count": char_count,
    "heading_count": heading_count,
    "line_runs": line_runs,
    "substring_repeats": substring_repeats,
    "repetition_flag": repetition_flag,
    "extraction_ratio": extraction_ratio,
    "validate_empty": validate_empty,
    "validate_short": validate_short,
    "validate_warnings": validate_warnings,
    "validate_all": validate_all,
    "validate_markdown": validate_markdown,
    "next_mode": next_modes,
    "escalate": escalated,
    "attempt_summary": attempt_rows,
    "attempts_made": attempts_made,
    "failed_docs": failed_docs,
    "quarantine": quarantined,
    "conversion_log": conversion_log,
    "log_json": log_json,
    "convert_batch": convert_batch,
    "convert_files": convert_files,
    "batch_summary": batch_summary,
    "document_summary": document_summary,
    "batch_failed": batch_failed,
    "outcome_rates": outcome_rates,
}
