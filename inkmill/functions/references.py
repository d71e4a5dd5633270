"""Character references (`&hellip;`, `&#8217;`, `&#x2014;`) to characters, in one pass over the text.

The text is split at its references and woven together again with what they stand for, so what one reference yields is never
taken for the beginning of another. The names are those of HTML 4 and `apos`; an unknown name stays as it is. As browsers do,
numbers 128 to 159 mean the characters that Windows-1252 has there, and numbers that are no character give U+FFFD.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.text import let

PATTERN = "&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
NAMES = " ".join(f"{name}={code}" for name, code in sorted({**name2codepoint, "apos": 0x27}.items()))


def _windows(code: int) -> int:
    return ord(bytes([code]).decode("cp1252", errors="replace")) if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else code


WINDOWS = ", ".join(str(_windows(code)) for code in range(0x80, 0xA0))


def _character(code: str) -> str:
    """The character of a code point."""
    invalid = f"{code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343"
    real = f"CASE WHEN {code} BETWEEN 128 AND 159 THEN element_at(array({WINDOWS}), {code} - 127) ELSE {code} END"
    return f"CASE WHEN {invalid} THEN decode(X'EFBFBD', 'UTF-8') ELSE decode(unhex(lpad(hex({real}), 8, '0')), 'UTF-32') END"


def references_decoded(text: str) -> str:
    """SQL text of the decoded `text`."""
    digits = "CASE WHEN lower(substring(r, 3, 1)) = 'x' THEN conv(substring(r, 4, length(r) - 4), 16, 10) ELSE substring(r, 3, length(r) - 3) END"
    named = f"element_at(str_to_map('{NAMES}', ' ', '='), substring(r, 2, length(r) - 2))"
    number = f"cast(CASE WHEN substring(r, 2, 1) = '#' THEN {digits} ELSE {named} END AS int)"
    found = f"transform(regexp_extract_all({text}, r'{PATTERN}', 0), r -> {let('code', number, f'coalesce({_character("code")}, r)')})"
    woven = let(
        "found",
        found,
        f"array_join(transform(split({text}, r'{PATTERN}', -1), (piece, i) -> concat(piece, coalesce(get(found, i), ''))), '')",
    )
    return f"CASE WHEN instr({text}, '&') > 0 THEN {woven} ELSE {text} END"


def decode_references(text: str) -> Column:
    """The text of a column, given by name or as an SQL expression, with its references decoded; null stays null."""
    return F.expr(references_decoded(text))
