"""Operator inputs derived from the given tables; `oracles` derives the same ones in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import html, markup
from inkmill.operators.extraction import Extractors, extracted
from inkmill.settings import Modes, Settings, Validation
from inkmill.sources.tables import documents, table, with_path_parts

# Fixed values shared with the SQL side.
FILE_EXTENSIONS = (".html", ".PDF", ".csv", ".jpg", ".tif", ".xyz", "", ".md", ".json", ".docx")
OVERRIDES = {".tif": "ocr", ".md": "high_accuracy", ".PDF": "ocr"}
TIER_MIN_RATIO = 0.7


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """documents: doc_id, text and its size."""
    return table(spark, sf, "documents", "doc_id", "text").withColumn("size", F.octet_length("text").cast("bigint"))


def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """documents as text files."""
    rows = table(spark, sf, "documents", "doc_id", "text", "source")
    return documents(rows, _text("/docs/", F.col("source"), "/", F.col("doc_id"), ".txt"), F.col("text"))


def markdown(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as Markdown that needs every normalization rule."""
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    turn, role, text = F.col("turn"), F.col("role"), F.col("text")
    raw = _text(
        "# Turn ", turn, "  \n\n\n\n##\n* ", F.replace(text, F.lit("\n"), F.lit("\n+ ")), " \t\n",
        "```txt\n* keep  \n##\n```\n\n",
        F.repeat(_text("speaker ", role, " said "), 3 + turn.cast("int") % 3), "\n",
        "\n\u3000+ see ~~~\n", turn, "\n~~~ here\u00a0\n###### \n",
    )
    return rows.select("conv_id", "turn", raw.alias("raw")).withColumn(
        "size", F.octet_length("raw").cast("bigint") * (1 + 200 * (F.col("conv_id") % 5 == 0).cast("int"))
    )


def files(spark: SparkSession, sf: str) -> DataFrame:
    """pages as files of ten kinds, three files to a stem."""
    rows = table(spark, sf, "pages", "page_id", "url", "html")
    page, url = F.col("page_id"), F.col("url")
    ext = F.element_at(F.array(*map(F.lit, FILE_EXTENSIONS)), (page % 10 + 1).cast("int"))
    path = _text("/in/", page % 7, "/doc", F.floor(page / 3), ext)
    html = F.col("html")
    quoted, escaped = F.replace(html, F.lit('"'), F.lit('""')), html
    for a, b in ("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    # Every format holds the whole page; one page in twenty is an empty file.
    text = (
        F.when(page % 20 == 5, F.lit(""))
        .when(page % 20 == 6, _text(url, "\n", html))
        .when(page % 10 == 2, _text('url,id,note\n"', url, '",', page, '\n\n"a ""b"" | c\nd",,,"', quoted, '"\n'))
        .when(page % 10 == 7, _text("# ", url, "\n\n* first\n+ second  \n", html))
        .when(page % 10 == 8, _text('{"id": ', page, ', "url": "', url, '", "html": "', escaped, '"}'))
        .otherwise(html)
    )
    return with_path_parts(rows.select("page_id", path.alias("path"), text.alias("text"))).withColumn(
        "size", F.octet_length("text").cast("bigint")
    )


#: First bytes of files, by page: PDF, JPEG, PNG, GIF, WebP, BMP, TIFF, a package, a text document, and none.
FIRST_BYTES = (
    "255044462D312E37", "FFD8FFE0", "89504E470D0A1A0A", "474946383961", "524946460000000057454250", "424D0000", "4D4D002A",
    "504B03040A00", "504B03040A00776F72642F646F63756D656E742E786D6C", "",
)


def byte_files(spark: SparkSession, sf: str) -> DataFrame:
    """pages as bytes behind the signatures of other formats."""
    rows = table(spark, sf, "pages", "page_id", "html")
    first = F.element_at(F.array(*map(F.lit, FIRST_BYTES)), (F.col("page_id") % len(FIRST_BYTES) + 1).cast("int"))
    return rows.select("page_id", F.concat(F.unhex(first), F.encode("html", "UTF-8")).alias("content"))


def converted_before(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the files that an earlier run is taken to have converted."""
    return files(spark, sf).filter(F.col("page_id") % 7 == 0).select("path", "stem")


def tier_files(spark: SparkSession, sf: str) -> DataFrame:
    """pages as files with a mode to start from."""
    rows = table(spark, sf, "pages", "page_id", "url", "html")
    page = F.col("page_id")
    shaped = documents(rows, _text("/tiers/", page, ".htm"), F.col("html"))
    return shaped.withColumns(
        {"mode": F.when(F.substring("stem", -1, 1) == "7", "paddle_ocr").otherwise("standard"), "skip": F.lit(False)}
    )


def tier_settings() -> Settings:
    return Settings(modes=Modes(), validation=Validation(min_extraction_ratio=TIER_MIN_RATIO))


def tier_modes() -> dict[str, Column]:
    """What each mode takes from a page: its paragraphs, headings too, all visible text, or an error for want of an engine."""
    text = F.col("text")
    headings = F.regexp_extract_all(text, F.lit(r"(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]\s*>"), F.lit(1))
    paragraphs = F.regexp_extract_all(text, F.lit(r"(?is)<p>(.*?)</p>"), F.lit(1))
    return {
        "standard": extracted(F.array_join(paragraphs, "\n\n")),
        "paddle_ocr": extracted(F.array_join(F.concat(headings, paragraphs), "\n\n")),
        "ocr": extracted(html.html_to_markdown("text"), html.html_title("text")),
        "high_accuracy": Extractors().get("high_accuracy")(),
    }


def tier_extractors() -> Extractors:
    return Extractors({mode: (lambda result=result: result) for mode, result in tier_modes().items() if mode != "high_accuracy"})


def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as two-record CSV files with quotes, commas and line feeds inside cells."""
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    quoted = F.replace(F.col("text"), F.lit("é"), F.lit('""'))
    content = _text("turn,role,text\n", F.col("turn"), ",", F.col("role"), ',"', quoted, '"\n', F.col("turn"), ',"a|b",,kept')
    return rows.select("conv_id", "turn", content.alias("text"))


def ocr_files(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as recognised pages: paragraphs are pages, sentences are lines, some of them malformed or blank."""
    rows = table(spark, sf, "conversations", "conv_id", "turn", "text")
    box = F.lit(None).cast("array<array<double>>")

    def line(text: Column) -> Column:
        info = F.struct(F.concat(F.lit(" "), text, F.lit("\u3000")).alias("text"), F.lit(0.9).alias("confidence"))
        return F.struct(box.alias("box"), F.when(~F.startswith(text, F.lit("L")), info).alias("info"))

    pages = F.transform(F.split("text", "\n", -1), lambda page: F.transform(F.split(page, r"\.", -1), line))
    return rows.select("conv_id", "turn", pages.cast(markup.OCR_TYPE).alias("ocr"))


def structured_pages(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as pages with nested and numbered lists, a pre element and a table."""
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    turn, role, text = F.col("turn"), F.col("role"), F.col("text")
    shown = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    first = F.substring_index(shown, "\n", 1)
    page = _text(
        "<h2>Turn ", turn, "</h2><ol start='", turn + 1, "'><li>", role, "<ul>\n<li>", first, "</li>\n<li><b>deep</b> &hellip;</li></ul>",
        "</li><li><p>one</p><p>two</p></ol><pre>\n", shown, "\n</pre><table>\n<tr><th>turn<th>text</tr>\n<tr><td>", turn, "</td><td>", shown,
        "</td></tr></table>",
    )
    return rows.select("conv_id", "turn", page.alias("text"))


#: Letters and how they are written as references.
REFERENCES = (("&", "&amp;"), ("é", "&eacute;"), ("e", "&#101;"), ("o", "&#x6F;"), (" ", "&#32;"))
MORE_REFERENCES = "&amp;lt;&#8217;&#x2014;&hellip;&unknown;&#0;&#150;&apos;&"


def referenced_texts(spark: SparkSession, sf: str) -> DataFrame:
    """documents with letters written as character references."""
    text = F.coalesce("text", F.lit(""))
    for plain, reference in REFERENCES:
        # What earlier steps wrote holds letters too.
        text = F.replace(text, F.lit(plain), F.lit(reference)) if plain in "&é" else F.regexp_replace(text, f"(?<![&#a-z]){plain}(?![a-z]*;)", reference)
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.concat(text, F.lit(MORE_REFERENCES)).alias("text"))


def encoded_files(spark: SparkSession, sf: str) -> DataFrame:
    """documents as bytes in five character sets, with and without a byte order mark."""
    rows = table(spark, sf, "documents", "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    latin = F.regexp_replace(text, "[^\\x00-\\xFF]", "?")
    kinds = {
        0: F.encode(text, "UTF-8"),
        1: F.concat(F.unhex(F.lit("EFBBBF")), F.encode(text, "UTF-8")),
        2: F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE")),
        3: F.encode(F.concat(F.lit("Plain letters come first. "), text), "UTF-16BE"),
        4: F.encode(latin, "ISO-8859-1"),
    }
    content = F.lit(None).cast("binary")
    for kind, value in kinds.items():
        content = F.when(F.col("doc_id") % 5 == kind, value).otherwise(content)
    return rows.select("doc_id", content.alias("content"))


PACKAGE_MEMBERS = ("word/document.xml", "notes/a.txt", "xl/workbook.xml", "ppt/presentation.xml", "mimetype")


def packages(spark: SparkSession, sf: str) -> DataFrame:
    """pages as ZIP packages of two stored members, whose content names the parts of other formats."""
    rows = table(spark, sf, "pages", "page_id", "html")
    kind = (F.col("page_id") % len(PACKAGE_MEMBERS)).cast("int")
    member = F.element_at(F.array(*map(F.lit, PACKAGE_MEMBERS)), kind + 1)
    content = F.when(member == "mimetype", F.lit("application/epub+zip")).otherwise(F.concat(F.lit("xl/workbook.xml word/document.xml "), "html"))
    shaped = rows.select("page_id", F.explode(F.array(F.lit(False), F.lit(True))).alias("cut"), F.encode(member, "UTF-8").alias("name"), F.encode(content, "UTF-8").alias("body"))

    def number(value: Column, size: int) -> Column:
        digits = F.lpad(F.hex(value), 8, "0")
        return F.unhex(F.concat(*[F.substring(digits, 7 - 2 * i, 2) for i in range(size)]))

    def raw(digits: str) -> Column:
        return F.unhex(F.lit(digits))

    n, size = F.octet_length("name"), F.octet_length("body")
    local = F.concat(raw("504B030414000000000000000000" + "00000000"), number(size, 4), number(size, 4), number(n, 2), raw("0000"), "name", "body")
    entry = F.concat(
        raw("504B010214001400000000000000000000000000"), number(size, 4), number(size, 4), number(n, 2), raw("0000" * 4 + "00000000"),
        number(F.lit(0), 4), "name",
    )
    end = F.concat(
        raw("504B0506" + "00000000" + "01000100"), number(F.octet_length("entry"), 4), number(F.octet_length("local"), 4), raw("0300"), F.encode(F.lit("end"), "UTF-8")
    )
    built = shaped.withColumns({"local": local, "entry": entry}).withColumn("whole", F.concat("local", "entry", end))
    # A package that was cut short has no directory.
    return built.select("page_id", "cut", F.when(F.col("cut"), F.col("local")).otherwise(F.col("whole")).alias("content"))
