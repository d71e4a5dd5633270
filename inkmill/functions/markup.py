"""Text formats to Markdown as column expressions: CSV and recognised lines (HTML has a module of its own)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.text import strip

# One CSV cell: quoted (doubled quotes inside, an open quote runs to the end) or bare, then its terminator. The
# possessive repeats keep matching linear and off the call stack.
CSV_CELL = r'(?<![^,\n])(?:"(?:[^"]++|"")*+(?:"|\z)[^,\n]*+|[^,\n]*+)(?:,|\n|\z)'

def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute `value` once for an expression that uses it several times."""
    return F.element_at(F.transform(F.array(value), body), 1)


OCR_TYPE = "array<array<struct<box:array<array<double>>,info:struct<text:string,confidence:double>>>>"


def csv_to_markdown(text: Column) -> Column:
    """A Markdown table: the first record is the header, the widest one sets the width. Blank records are left out."""

    def table(tokens: Column) -> Column:
        def content(token: Column) -> Column:
            # Quotes and terminator off, doubled quotes undone.
            quoted = F.regexp_extract(token, r'(?s)\A"((?:[^"]++|"")*+)(?:"|\z)([^,\n]*+)', 1)
            rest = F.regexp_extract(token, r'(?s)\A"(?:[^"]++|"")*+(?:"|\z)([^,\n]*+)', 1)
            bare = F.regexp_replace(token, r"[,\n]\z", "")
            value = F.when(F.startswith(token, F.lit('"')), F.concat(F.replace(quoted, F.lit('""'), F.lit('"')), rest))
            value = F.regexp_replace(value.otherwise(bare), r"\r\z", "")
            return F.replace(F.regexp_replace(value, r"\r?\n", " "), F.lit("|"), F.lit("\\|"))

        cells = F.transform(tokens, content)
        ends = F.filter(
            F.transform(
                tokens, lambda t, i: F.when(F.endswith(t, F.lit("\n")) | (i == F.size(tokens) - 1), i + 1)
            ),
            lambda end: end.isNotNull(),
        )

        def assemble(parts: Column) -> Column:
            def record(end: Column, i: Column) -> Column:
                start = F.when(i == 0, F.lit(0)).otherwise(F.get(parts["ends"], i - 1))
                return F.slice(parts["cells"], start + 1, end - start)

            records = F.filter(F.transform(parts["ends"], record), lambda r: ~((F.size(r) == 1) & (F.get(r, F.lit(0)) == "")))
            return _let(records, render)

        return _let(F.struct(cells.alias("cells"), ends.alias("ends")), assemble)

    def render(records: Column) -> Column:
        width = F.coalesce(F.array_max(F.transform(records, F.size)), F.lit(0))

        def row(r: Column) -> Column:
            full = F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), F.lit(1), width)
            return F.concat(F.lit("| "), F.array_join(full, " | "), F.lit(" |"))

        rule = row(F.array_repeat(F.lit("---"), width))
        rows = F.transform(records, row)
        every = F.concat(F.slice(rows, 1, 1), F.array(rule), F.slice(rows, F.lit(2), F.size(rows)))
        return F.when(F.size(records) == 0, F.lit("")).otherwise(F.array_join(every, "\n"))

    return _let(F.regexp_extract_all(text, F.lit(CSV_CELL), F.lit(0)), table)


def ocr_to_markdown(pages: Column) -> Column:
    """Recognised lines of one file (pages of lines of box and text) as paragraphs; blank and malformed lines are left out."""
    found = F.filter(F.flatten(F.filter(pages, lambda page: page.isNotNull())), lambda line: line["info"]["text"].isNotNull())
    texts = F.filter(F.transform(found, lambda line: strip(line["info"]["text"])), lambda t: t != "")
    return F.array_join(F.coalesce(texts, F.array().cast("array<string>")), "\n\n")
