"""Choose the extraction mode of each document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import sniff
from inkmill.settings import Modes

# Extension -> mode.
EXTENSION_MODES = {
    **dict.fromkeys(
        (
            ".pdf", ".docx", ".doc", ".pptx", ".ppt", ".xlsx", ".xls", ".csv", ".html", ".htm", ".json", ".xml",
            ".epub", ".zip", ".txt", ".md", ".rst",
        ),
        "standard",
    ),
    **dict.fromkeys((".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".tif", ".tiff"), "paddle_ocr"),
}
# Content type -> mode.
TYPE_MODES = {
    **dict.fromkeys(
        (
            "application/pdf",
            "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
            "application/vnd.openxmlformats-officedocument.presentationml.presentation",
            "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
            "text/html", "text/csv", "text/plain", "application/json", "application/xml", "text/xml",
            "application/epub+zip", "application/zip",
        ),
        "standard",
    ),
    **dict.fromkeys(
        ("image/jpeg", "image/png", "image/gif", "image/webp", "image/bmp", "image/tiff"), "paddle_ocr"
    ),
}
UNKNOWN = "unknown"


def lookup(table: Mapping[str, str], key: Column) -> Column:
    """Value from a small literal table; null where the key is missing."""
    if not table:
        return F.lit(None).cast("string")
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*entries), key)


def mode_by_extension(ext: Column) -> Column:
    return lookup(EXTENSION_MODES, ext)


def mode_by_override(ext: Column, modes: Modes) -> Column:
    """The user's table; its keys are compared as written with the lower-cased extension."""
    return lookup(modes.extension_overrides, ext)


def detected_type(df: DataFrame) -> Column:
    """Content type from the signature where there are bytes, else from the text."""
    by_text = sniff.text_type(F.col("text"))
    return F.coalesce(sniff.binary_type("content"), by_text) if "content" in df.columns else by_text


def mode_by_content(df: DataFrame) -> Column:
    return lookup(TYPE_MODES, detected_type(df))


def route(df: DataFrame, modes: Modes = Modes(), forced: str | None = None) -> DataFrame:
    """Add `mode`: forced, else override, else extension, else content, else unknown.

    `coalesce` stops at the first hit, so content is only looked at when the extension says nothing.
    """
    if forced:
        return df.withColumn("mode", F.lit(forced))
    ext = F.col("ext")
    return df.withColumn(
        "mode",
        F.coalesce(mode_by_override(ext, modes), mode_by_extension(ext), mode_by_content(df), F.lit(UNKNOWN)),
    )


def unsupported_reason(name_suffix: Column) -> Column:
    return F.concat(F.lit("unsupported file type: "), name_suffix)
