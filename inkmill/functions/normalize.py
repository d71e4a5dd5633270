"""Markdown normalization as column expressions.

Each step takes a column name (or any SQL expression) and is usable alone; `normalize` chains them. A step that works
per line uses a higher-order function over the document's line array, so a document never leaves its row and nothing
is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.repeats import collapsed_line
from inkmill.functions.text import BLANKS, INLINE_BLANKS, WS, ends_blank, let, lines, sql_text, starts_blank
from inkmill.settings import Normalization

# Fixed values.
FENCED_BLOCK = r"(?s)```[^\n]*\n.*?```|~~~[^\n]*\n.*?~~~"
TOKEN_PREFIX, TOKEN_SUFFIX = "__CODEBLOCK_", "__"

TOKEN_PATTERN = f"{TOKEN_PREFIX}[0-9a-f]{{32}}{TOKEN_SUFFIX}"


def _block_token(position: str, block: str) -> str:
    """Stand-in for a code block: 32 hex digits, of which the middle 8 number the block and the others depend on it."""
    digest = f"md5(concat(cast({position} AS string), {block}))"
    number = f"lpad(lower(hex({position})), 8, '0')"
    return f"concat('{TOKEN_PREFIX}', left({digest}, 12), {number}, substring({digest}, 13, 12), '{TOKEN_SUFFIX}')"


def _interleave(pieces: str, between: str) -> str:
    """p1 b1 p2 b2 ... pn, in one linear pass."""
    return f"array_join(transform({pieces}, (piece, i) -> concat(piece, coalesce(get({between}, i), ''))), '')"


def _code_blocks(text: str) -> str:
    # Without a fence, a line feed after it and a second fence after that, no block exists and the pattern, which would
    # try every fence to the end of the text, is not run.
    closed = [
        f"""exists(array(instr({text}, '{fence}')), opening -> opening > 0
            AND exists(array(position('
', {text}, opening + 3)), feed -> feed > 0
            AND position('{fence}', {text}, feed + 1) > 0))"""
        for fence in ("```", "~~~")
    ]
    return f"""CASE WHEN {' OR '.join(closed)}
        THEN regexp_extract_all({text}, r'{FENCED_BLOCK}', 0) ELSE cast(array() AS array<string>) END"""


def _protect_code(text: str, blocks: str) -> str:
    tokens = f"transform({blocks}, (block, i) -> {_block_token('i', 'block')})"
    woven = let("tokens", tokens, _interleave(f"split({text}, r'{FENCED_BLOCK}', -1)", "tokens"))
    return f"CASE WHEN size({blocks}) = 0 THEN {text} ELSE {woven} END"


def _restore_code(text: str, blocks: str) -> str:
    number = f"cast(conv(substring(token, {len(TOKEN_PREFIX) + 13}, 8), 16, 10) AS bigint)"
    original = let(
        "n",
        f"CASE WHEN {number} < size({blocks}) THEN cast({number} AS int) END",
        f"CASE WHEN {_block_token('n', f'get({blocks}, n)')} = token THEN get({blocks}, n) ELSE token END",
    )
    found = f"transform(regexp_extract_all({text}, r'{TOKEN_PATTERN}', 0), token -> {original})"
    woven = let("found", found, _interleave(f"split({text}, r'{TOKEN_PATTERN}', -1)", "found"))
    return f"CASE WHEN size({blocks}) = 0 THEN {text} ELSE {woven} END"


def _strip_trailing(text: str) -> str:
    trimmed = f"CASE WHEN {ends_blank('line')} THEN rtrim({sql_text(INLINE_BLANKS)}, line) ELSE line END"
    return f"array_join(transform({lines(text)}, line -> {trimmed}), '\n')"


def _collapse_newlines(text: str, most: int) -> str:
    return f"regexp_replace({text}, r'\\n{{{most + 1},}}', '{chr(10) * most}')"


def _unify_bullets(text: str, bullet: str) -> str:
    literal = re.sub(r"([\\$])", r"\\\1", bullet)
    return f"regexp_replace({text}, r'(?md)^([{WS}]*+)[*+]([{WS}]++)', {sql_text(f'$1{literal}$2')})"


def _kept_lines(text: str) -> str:
    empty = f"startswith(line, '#') AND line RLIKE r'\\A#{{1,6}}[{WS}]*+\\z'"
    return f"filter({lines(text)}, line -> NOT ({empty}))"


def _strip(text: str) -> str:
    blank = f"{starts_blank(text)} OR {ends_blank(text)}"
    return f"CASE WHEN {blank} THEN btrim({text}, {sql_text(BLANKS)}) ELSE {text} END"


def code_blocks(text: str) -> Column:
    """Fenced blocks in order of appearance."""
    return F.expr(_code_blocks(text))


def protect_code(text: str, blocks: str) -> Column:
    """Replace the `blocks` (from `code_blocks`) by tokens."""
    return F.expr(_protect_code(text, blocks))


def restore_code(text: str, blocks: str) -> Column:
    """Put the blocks back. Each token names its block, so the work is linear in the text, however many blocks it has."""
    return F.expr(_restore_code(text, blocks))


def strip_trailing(text: str) -> Column:
    """Drop blanks at line ends. Only the last character of each line is looked at, unless it is a blank."""
    return F.expr(_strip_trailing(text))


def collapse_newlines(text: str, most: int = 2) -> Column:
    """Runs of more than `most` line feeds become exactly `most`."""
    return F.expr(_collapse_newlines(text, most))


def unify_bullets(text: str, bullet: str = "-") -> Column:
    """List items that start with `*` or `+` get the given bullet; indentation and spacing stay."""
    return F.expr(_unify_bullets(text, bullet))


def drop_empty_headings(text: str) -> Column:
    """Remove lines that are a heading mark without a title."""
    return F.expr(f"array_join({_kept_lines(text)}, '\n')")


def collapse_repeats(text: str) -> Column:
    """Per line: if a prefix of 10+ characters occurs three times in a row anywhere, keep one copy; longest prefix first."""
    return F.expr(f"array_join(transform({lines(text)}, line -> {collapsed_line('line')}), '\n')")


def strip_document(text: str) -> Column:
    """Remove blanks at both ends; text that has none is passed through without a copy."""
    return F.expr(_strip(text))


def normalize(text: str, options: Normalization = Normalization()) -> Column:
    """All steps in order. Empty and null text is returned as it is."""
    body = _collapse_newlines(_strip_trailing(_protect_code(text, "blocks")), options.max_consecutive_newlines)
    kept = _kept_lines(_unify_bullets(body, options.bullet_char))
    joined = f"array_join(transform({kept}, line -> {collapsed_line('line')}), '\n')"
    restored = let("body", let("joined", joined, _strip("joined")), _restore_code("body", "blocks"))
    return F.expr(f"CASE WHEN length({text}) > 0 THEN {let('blocks', _code_blocks(text), restored)} ELSE {text} END")
