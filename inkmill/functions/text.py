"""Text helpers shared by the normalization and validation expressions.

Long expressions are written as Spark SQL text: nested lambdas read better that way, and Spark parses one string much
faster than Python can assemble a thousand Column objects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All Unicode blanks (they all lie below U+3001), with and without the line feed.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
INLINE_BLANKS = BLANKS.replace("\n", "")


def char_class(chars: str) -> str:
    """Body of a regular-expression class, in the notation Java and RE2 have in common."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


WS = char_class(INLINE_BLANKS)
WS_NL = char_class(BLANKS)


def sql_text(value: str) -> str:
    """A string literal without escapes; text with a quote goes in as bytes."""
    return f"decode(X'{value.encode().hex()}', 'UTF-8')" if "'" in value else f"r'{value}'"


def let(name: str, value: str, body: str) -> str:
    """`body` with `value` computed once and bound to `name`."""
    return f"transform(array({value}), {name} -> {body})[0]"


def lines(text: str) -> str:
    return f"split({text}, '\n', -1)"


def starts_blank(text: str) -> str:
    """First character is a blank; also true for the empty string."""
    return f"(instr({sql_text(BLANKS)}, left({text}, 1)) > 0)"


def ends_blank(text: str) -> str:
    """Last character is a blank; also true for the empty string."""
    return f"(instr({sql_text(BLANKS)}, right({text}, 1)) > 0)"


def has_ink(line: str) -> str:
    """The line holds something besides blanks. The first character decides nearly always."""
    return f"(NOT {starts_blank(line)} OR {line} RLIKE r'[^{WS_NL}]')"


def strip(text: Column) -> Column:
    """Remove blanks at both ends."""
    return F.btrim(text, F.lit(BLANKS))
