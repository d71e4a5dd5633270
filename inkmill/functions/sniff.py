"""Content type from the content itself."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public file signatures as (type, first byte, hexadecimal bytes).
SIGNATURES = (
    ("application/pdf", 0, "255044462D"),
    ("image/jpeg", 0, "FFD8FF"),
    ("image/png", 0, "89504E470D0A1A0A"),
    ("image/gif", 0, "47494638"),
    ("image/webp", 8, "57454250"),
    ("image/bmp", 0, "424D"),
    ("image/tiff", 0, "49492A00"),
    ("image/tiff", 0, "4D4D002A"),
)
ZIP_SIGNATURE = "504B0304"
# Members by which packages that share the ZIP signature are told apart, and the first member of an EPUB.
ZIP_MEMBERS = {
    "word/document.xml": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "ppt/presentation.xml": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "xl/workbook.xml": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
EPUB_START = "mimetypeapplication/epub+zip"
#: The end record of a package: 22 bytes and a comment of at most 65,535.
ZIP_TAIL = 22 + 65535


def text_type(text: Column) -> Column:
    """Type of decoded text; null for empty text."""
    bracketed = F.startswith(text, F.lit("{")) | F.startswith(text, F.lit("["))
    return (
        F.when(F.length(text) == 0, F.lit(None).cast("string"))
        .when(text.rlike(r"(?i)\A\s*<(!doctype\s+html|html)\b"), F.lit("text/html"))
        .when(F.startswith(text, F.lit("<?xml")), F.lit("application/xml"))
        .when(bracketed & F.try_parse_json(text).isNotNull(), F.lit("application/json"))
        .when(text.isNotNull(), F.lit("text/plain"))
    )


def _number(content: str, first: str, size: int) -> str:
    """Little-endian number of `size` bytes from the 1-based place `first`."""
    digits = ", ".join(f"hex(substring({content}, cast({first} + {i} AS int), 1))" for i in reversed(range(size)))
    return f"cast(conv(concat({digits}), 16, 10) AS bigint)"


def package_type(content: str) -> str:
    """SQL text: type of a ZIP package by the names in its central directory.

    The directory is found through the end record in the file's tail and walked entry by entry; what the members hold is not
    looked at. A package without a readable directory, or with other names, is a plain ZIP file.
    """
    members = ", ".join(f"'{name}', '{kind}'" for name, kind in ZIP_MEMBERS.items())
    name = f"cast(substring(listed, s.p + 46, {_small('listed', 's.p + 28')}) AS string)"
    length = f"46 + {' + '.join(_small('listed', f's.p + {at}') for at in (28, 30, 32))}"
    entry = f"""CASE WHEN s.p > 0 AND s.kind IS NULL AND hex(substring(listed, s.p, 4)) = '504B0102'
        THEN named_struct('p', s.p + {length}, 'kind', element_at(map({members}), {name}))
        ELSE named_struct('p', 0, 'kind', s.kind) END"""
    walked = f"""aggregate(sequence(1, entries), named_struct('p', 1, 'kind', cast(NULL AS string)), (s, i) -> {entry}, s -> s.kind)"""
    record = f"substring(tail, at, 22)"
    listing = f"""transform(array(struct({_number('record', '11', 2)} AS n, {_number('record', '13', 4)} AS size, {_number('record', '17', 4)} AS first)), d ->
        CASE WHEN d.n > 0 AND d.first + d.size <= octet_length({content})
        THEN transform(array(substring({content}, cast(d.first + 1 AS int), cast(d.size AS int))), listed ->
            transform(array(cast(d.n AS int)), entries -> {walked})[0])[0] END)[0]"""
    # Latin-1 keeps one character per byte, so places in the text are places in the bytes.
    found = f"""transform(array(substring({content}, greatest(octet_length({content}) - {ZIP_TAIL}, 0) + 1, {ZIP_TAIL})), tail ->
        transform(array(octet_length(tail) - 2 - instr(reverse(decode(tail, 'ISO-8859-1')), decode(X'06054B50', 'ISO-8859-1'))), at ->
            CASE WHEN at > 0 AND at <= octet_length(tail) - 21 THEN transform(array({record}), record -> {listing})[0] END)[0])[0]"""
    epub = f"CASE WHEN cast(substring({content}, 31, {len(EPUB_START)}) AS string) = '{EPUB_START}' THEN 'application/epub+zip' END"
    return f"coalesce({epub}, {found}, 'application/zip')"


def _small(content: str, first: str) -> str:
    return f"cast({_number(content, first, 2)} AS int)"


def binary_type(content: str) -> Column:
    """Type by signature; null if none fits."""

    def starts_with(first: int, digits: str) -> str:
        return f"hex(substring({content}, {first + 1}, {len(digits) // 2})) = '{digits}'"

    cases = [f"WHEN {starts_with(0, ZIP_SIGNATURE)} THEN {package_type(content)}"]
    cases += [f"WHEN {starts_with(first, digits)} THEN '{kind}'" for kind, first, digits in SIGNATURES]
    return F.expr(f"CASE {' '.join(cases)} END")


# Two-byte units as regular expressions over bytes that are read as Latin-1. Alternatives differ in one byte and runs are possessive,
# so each expression is one pass over the bytes, without recursion.
def _latin(expression: str) -> str:
    return f"r'(?s){expression}'"


def _unit(order: str, first: str, second: str) -> str:
    """A unit with its first byte in big-endian order and the other one."""
    return first + second if order == "big" else second + first


def _paired(s: str, order: str) -> str:
    """Every surrogate has its partner; `s` holds the bytes as Latin-1."""
    pair = _unit(order, r"[\xD8-\xDB]", ".") + _unit(order, r"[\xDC-\xDF]", ".")
    return f"{s} RLIKE {_latin(rf'\A(?:{_unit(order, r'[^\xD8-\xDF]', '.')}|{pair})*+\z')}"


def _plain(s: str, order: str) -> str:
    """Every surrogate has its partner, and no unit is a control character that text does not hold."""
    pair = _unit(order, r"[\xD8-\xDB]", ".") + _unit(order, r"[\xDC-\xDF]", ".")
    basic = _unit(order, r"\x00", r"[\x09-\x0D\x20-\x7E\x80-\xFF]")
    return f"{s} RLIKE {_latin(rf'\A(?:{basic}|{_unit(order, r'[\x01-\xD7\xE0-\xFF]', '.')}|{pair})*+\z')}"


def _zeros(s: str, order: str) -> str:
    """Units whose first byte in big-endian order is zero: what is shorter without the runs of them, in units."""
    runs = rf"\G((?:{_unit(order, r'[^\x00]', '.')})*+)(?:{_unit(order, r'\x00', '.')})++"
    return f"div(length({s}) - length(regexp_replace({s}, {_latin(runs)}, '$1')), 2)"


def charset(content: str) -> Column:
    """Character set of text: by its mark; by zero bytes at every other place; UTF-8 if it is valid; else, without control
    characters and known signatures, a single-byte set. Null for anything else, as binary formats are."""
    return F.expr(_charset(content))


def _charset(content: str) -> str:
    signed = " OR ".join(
        f"hex(substring({content}, {first + 1}, {len(digits) // 2})) = '{digits}'"
        for _, first, digits in (*SIGNATURES, ("", 0, ZIP_SIGNATURE))
    )
    even = "octet_length(b) % 2 = 0"
    bound = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    in_latin = lambda body: bound("decode(b, 'ISO-8859-1')", "s", body)
    # Of the units' first bytes in big-endian order, nearly all are zero in Western text, and few of their second bytes.
    zeros = f"named_struct('little', {_zeros('s', 'little')}, 'big', {_zeros('s', 'big')})"
    guessed = in_latin(bound(zeros, "z", f"""CASE
        WHEN {even} AND 10 * z.little >= 2 * octet_length(b) AND 20 * z.big <= octet_length(b) AND {_plain('s', 'little')} THEN 'UTF-16LE'
        WHEN {even} AND 10 * z.big >= 2 * octet_length(b) AND 20 * z.little <= octet_length(b) AND {_plain('s', 'big')} THEN 'UTF-16BE' END"""))  # fmt: skip
    return f"""transform(array({content}), b -> CASE
        WHEN hex(substring(b, 1, 3)) = 'EFBBBF' THEN CASE WHEN is_valid_utf8(cast(b AS string)) AND NOT contains(b, X'00') THEN 'UTF-8' END
        WHEN hex(substring(b, 1, 2)) = 'FFFE' THEN CASE WHEN {even} AND {in_latin(_paired('s', 'little'))} THEN 'UTF-16LE' END
        WHEN hex(substring(b, 1, 2)) = 'FEFF' THEN CASE WHEN {even} AND {in_latin(_paired('s', 'big'))} THEN 'UTF-16BE' END
        WHEN contains(b, X'00') THEN CASE WHEN NOT ({signed}) THEN {guessed} END
        WHEN is_valid_utf8(cast(b AS string)) THEN 'UTF-8'
        WHEN NOT ({signed}) AND NOT decode(b, 'ISO-8859-1') RLIKE r'[\x01-\x08\x0E-\x1F\x7F]' THEN 'windows-1252' END)[0]"""


def decoded(content: str) -> Column:
    """Content as text without its byte order mark, or null if it is not text. Single-byte text is read as Windows-1252, which
    has letters and marks where Latin-1 has control characters."""
    c1 = "".join(chr(c) for c in range(0x80, 0xA0))
    windows = "".join(bytes([ord(c)]).decode("cp1252", errors="ignore") or c for c in c1)
    single = f"translate(decode(b, 'ISO-8859-1'), decode(X'{c1.encode().hex()}', 'UTF-8'), decode(X'{windows.encode().hex()}', 'UTF-8'))"
    text = f"""CASE s.c WHEN 'UTF-8' THEN cast(b AS string) WHEN 'UTF-16LE' THEN decode(b, 'UTF-16LE')
        WHEN 'UTF-16BE' THEN decode(b, 'UTF-16BE') WHEN 'windows-1252' THEN {single} END"""
    bound = f"transform(array(struct({_charset(content)} AS c, {content} AS b)), s -> transform(array(s.b), b -> {text})[0])[0]"
    return F.expr(f"transform(array({bound}), t -> CASE WHEN startswith(t, decode(X'EFBBBF', 'UTF-8')) THEN substring(t, 2) ELSE t END)[0]")
