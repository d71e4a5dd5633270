"""Extractors: from a document to Markdown text, an optional title, or an error.

An extraction mode is served by one of two kinds of extractor. A column extractor is an expression and runs in the same
stage as everything else. A Python extractor wraps a user's engine (an OCR model, an office-format decoder, a remote
service) in an Arrow function; only what it reads, of the rows that reached its mode, is sent to Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import html, markup, sniff

RESULT_TYPE = "struct<raw_md:string,title:string,extract_error:string>"

# Fixed values.
HTML_EXTENSIONS = (".html", ".htm")
CSV_EXTENSIONS = (".csv",)
TEXT_EXTENSIONS = (".json", ".xml", ".txt", ".md", ".rst")
PACKAGED_EXTENSIONS = (".pdf", ".docx", ".doc", ".pptx", ".ppt", ".xlsx", ".xls", ".epub", ".zip")
EXTERNAL_MODES = ("paddle_ocr", "ocr", "high_accuracy")


def extracted(raw_md: Column, title: Column | None = None) -> Column:
    """A result; missing text counts as empty."""
    title = F.lit(None) if title is None else title
    return F.struct(
        F.coalesce(raw_md, F.lit("")).alias("raw_md"), title.alias("title"), F.lit(None).alias("extract_error")
    ).cast(RESULT_TYPE)


def failed(error: Column) -> Column:
    return F.struct(F.lit(None).alias("raw_md"), F.lit(None).alias("title"), error.alias("extract_error")).cast(
        RESULT_TYPE
    )


def standard() -> Column:
    """Text formats by extension, else by content. Packaged and binary formats need a registered extractor."""
    text, ext = F.col("text"), F.col("ext")
    known = ext.isin(*HTML_EXTENSIONS, *CSV_EXTENSIONS, *TEXT_EXTENSIONS)
    is_html = ext.isin(*HTML_EXTENSIONS) | (~known & (sniff.text_type(text) == "text/html"))
    return (
        F.when(ext.isin(*PACKAGED_EXTENSIONS), failed(F.concat(F.lit("no extractor registered for "), ext)))
        .when(text.isNull(), failed(F.lit("content is not text")))
        .when(is_html, extracted(html.html_to_markdown("text"), html.html_title("text")))
        .when(ext.isin(*CSV_EXTENSIONS), extracted(markup.csv_to_markdown(text)))
        .otherwise(extracted(text))
    )


def recognised() -> Column:
    """OCR modes on a table that already carries recognition results in a column `ocr`."""
    return F.when(F.col("ocr").isNull(), failed(F.lit("no recognition result"))).otherwise(
        extracted(markup.ocr_to_markdown(F.col("ocr")))
    )


@dataclass(frozen=True)
class PythonExtractor:
    """`factory()` builds an engine once per partition; `engine(row_dict)` returns (text, title) or raises.

    Only the columns named in `inputs` go to Python, of the active rows; everything else stays where it is. An engine that
    cannot be built, raises, or answers with something other than text, is an error of the document.
    """

    factory: Callable[[], Callable[[dict], tuple[str | None, str | None]]]
    inputs: tuple[str, ...] = ("path", "text")

    def __call__(self, active: Column | None = None) -> Column:
        """A struct of raw_md, title and extract_error; null where not active."""
        factory = self.factory

        def attempt(engine, row: dict) -> dict:
            try:
                text, title = engine(row)
                for value in (text, title):
                    if value is not None and not isinstance(value, str):
                        raise TypeError(f"extractor answered with {type(value).__name__} instead of text")
                return {"raw_md": text or "", "title": title, "extract_error": None}
            except Exception as e:  # a broken document must not stop the job
                return {"raw_md": None, "title": None, "extract_error": str(e) or type(e).__name__}

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            engine = None
            for batch in batches:
                if engine is None:
                    try:
                        engine = factory()
                    except Exception as e:
                        engine = _raising(e)
                rows = batch.to_pylist()
                yield pa.array([None if row is None else attempt(engine, row) for row in rows], _ANSWER)

        row = F.struct(*[F.col(name) for name in self.inputs])
        wanted = row if active is None else F.when(active, row)
        return F.arrow_udf(run, RESULT_TYPE).asNondeterministic()(wanted)


_ANSWER = pa.struct([("raw_md", pa.string()), ("title", pa.string()), ("extract_error", pa.string())])


def _raising(error: Exception) -> Callable[[dict], tuple[str | None, str | None]]:
    def engine(row: dict) -> tuple[str | None, str | None]:
        raise error

    return engine


@dataclass(frozen=True)
class Unavailable:
    """A mode that needs an outside engine nobody registered; every document that reaches it gets this error."""

    error: str

    def __call__(self) -> Column:
        return failed(F.lit(self.error))


Extractor = Callable[[], Column] | PythonExtractor | Unavailable


@dataclass(frozen=True)
class Extractors:
    """Extraction modes. Modes that need an outside engine report an error until one is registered."""

    registered: Mapping[str, Extractor] = field(default_factory=dict)

    def get(self, mode: str) -> Extractor:
        if mode in self.registered:
            return self.registered[mode]
        if mode in EXTERNAL_MODES:
            return Unavailable(f"no extractor registered for mode '{mode}'")
        return self.registered.get("standard", standard)


def extract(df: DataFrame, extractor: Extractor) -> DataFrame:
    """Stand-alone extraction: adds raw_md, title and extract_error."""
    return df.withColumn("extracted", extractor()).select(*df.columns, "extracted.*")
