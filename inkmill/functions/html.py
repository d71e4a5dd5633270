"""HTML to Markdown: one fold over the page's tags and texts, with a stack of open lists.

The page is cut into tokens: comments and elements that are not shown, `pre` elements, tags, and the text between them. Each token
adds one piece of Markdown that depends on what is open where it stands: lists (nested ones are indented below their item, ordered
ones count), a table and its rows and cells, a link. Pieces are gathered in groups, so that adding one does not copy all those
before it.

Rules. Headings become `#` marks, list items `* ` or their number, links `[text](target)`, `br` a line feed, `hr` a line `---`,
other block elements blank lines, `pre` a fenced block. A table becomes a Markdown table whose first row is the header; line feeds
in a cell become blanks and `|` is escaped; end tags of cells and rows may be missing; a table within a cell is plain text of the
cell. Inside a list item, a new block or text after an inner list starts a new, indented line. Other tags are dropped, their
text stays. References are decoded once, after the tags are found. A link that is never closed ends with the page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.references import references_decoded
from inkmill.functions.text import let, strip

# Elements that are blocks of their own, and cells.
BLOCKS = (
    "address", "article", "aside", "blockquote", "caption", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "footer", "form",
    "header", "main", "nav", "p", "pre", "section", "summary",
)
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
HIDDEN = r"<!--.*?-->|<(script|style|title|head)\b.*?</\1\s*>"
TOKEN = rf"(?is){HIDDEN}|<pre\b[^>]*>.*?</pre\s*>|</?[a-z!][^>]*>|[^<]++|<"
#: Pieces that are joined at once.
GROUP = 256

_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''\s>]+))""".replace("''", "'")
_PRE = r"(?is)\A<pre\b[^>]*>(?:\r?\n)?(.*?)(?:\r?\n)?</pre\s*>\z"


def _text(literal: str) -> str:
    """A literal that may hold quotes and line feeds."""
    return f"decode(X'{literal.encode().hex()}', 'UTF-8')"


NL, NL2 = _text("\n"), _text("\n\n")


def _token(tok: str) -> str:
    """kind and value of a token: `t` text, `x` nothing to show, `pre` with its content, `a` with its target, `ol` with its first
    number, `h` with its marks, `p` for all blocks; end tags begin with a slash."""
    name = rf"lower(regexp_extract({tok}, r'\A<(/?[a-zA-Z][a-zA-Z0-9]*+)', 1))"
    href = " , ".join(f"nullif(regexp_extract({tok}, {_text(_HREF)}, {g}), '')" for g in (1, 2, 3))
    link = f"CASE WHEN {tok} RLIKE r'(?i)\\bhref\\s*=' THEN {references_decoded('link')} END"
    link = f"transform(array(coalesce({href}, '')), link -> {link})[0]"
    start = rf"regexp_extract({tok}, r'(?i)\bstart\s*=\s*[\x22\x27]?([0-9]{{1,9}})', 1)"
    content = rf"regexp_replace(regexp_extract({tok}, r'{_PRE}', 1), r'(?is)<!--.*?-->|</?[a-z!][^>]*>', '')"
    content = f"transform(array({content}), inner -> {references_decoded('inner')})[0]"
    blocks = ", ".join(f"'{slash}{b}'" for b in BLOCKS for slash in ("", "/"))
    kind = f"""CASE WHEN name = 'pre' AND {tok} RLIKE r'{_PRE}' THEN 'pre'
        WHEN name IN ({blocks}) THEN CASE WHEN startswith(name, '/') THEN '/p' ELSE 'p' END
        WHEN name RLIKE '^/?h[1-6]$' THEN left(name, length(name) - 1)
        WHEN name IN ('ul', '/ul', 'ol', '/ol', 'li', 'br', 'hr', 'a', '/a', 'table', '/table', 'tr', '/tr') THEN name
        WHEN name IN ('td', 'th') THEN 'td' WHEN name IN ('/td', '/th') THEN '/td' ELSE 'x' END"""
    value = f"""CASE k WHEN 'a' THEN {link} WHEN 'ol' THEN {start} WHEN 'h' THEN repeat('#', cast(right(name, 1) AS int))
        WHEN 'pre' THEN {content} END"""
    tag = let("name", name, let("k", kind, f"named_struct('k', k, 'v', {value})"))
    shown = f"named_struct('k', 't', 'v', {references_decoded(tok)})"
    return f"CASE WHEN startswith({tok}, '<') AND length({tok}) > 1 THEN {tag} ELSE {shown} END"


def _indent(kinds: str) -> str:
    """Blanks as wide as the markers of the open lists."""
    return f"replace(replace({kinds}, 'u', '  '), 'o', '   ')"


def _piece() -> str:
    """What token t adds in state s."""
    closed = "CASE WHEN s.href IS NULL THEN '' ELSE concat('](', s.href, ')') END"
    row_end = f"""concat(CASE WHEN s.cell THEN ' |' ELSE '' END,
        CASE WHEN s.row = 1 AND s.opened THEN concat({NL}, '|', repeat(' --- |', s.cells)) ELSE '' END)"""
    in_cell = f"replace(regexp_replace(t.v, r'\\s*\\n\\s*', ' '), '|', {_text(chr(92) + '|')})"
    in_list = f"concat(CASE WHEN s.gap AND t.v RLIKE r'\\S' THEN concat({NL}, {_indent('s.kinds')}) ELSE '' END, t.v)"
    marker = f"""CASE WHEN right(s.kinds, 1) = 'o' THEN concat(cast(element_at(s.numbers, -1) AS string), '. ') ELSE '* ' END"""
    fence = "CASE WHEN contains(t.v, '```') THEN '~~~' ELSE '```' END"
    return f"""CASE t.k
        WHEN 't' THEN CASE WHEN s.cell THEN {in_cell} WHEN s.tables > 0 AND NOT t.v RLIKE r'\\S' THEN ''
            WHEN s.gap THEN {in_list} ELSE t.v END
        WHEN 'x' THEN ''
        WHEN 'a' THEN concat({closed}, CASE WHEN t.v IS NULL THEN '' ELSE '[' END)
        WHEN '/a' THEN {closed}
        WHEN 'tr' THEN CASE WHEN s.tables = 0 THEN {NL2} WHEN s.tables > 1 THEN ' ' ELSE {row_end} END
        WHEN '/tr' THEN CASE WHEN s.tables = 0 THEN {NL2} WHEN s.tables > 1 THEN ' ' ELSE {row_end} END
        WHEN 'td' THEN CASE WHEN s.tables = 0 THEN '' WHEN s.tables > 1 THEN ' ' WHEN NOT s.opened THEN concat({NL}, '| ')
            WHEN s.cell THEN ' | ' ELSE ' ' END
        WHEN '/td' THEN CASE WHEN s.tables = 1 AND s.cell THEN ' |' WHEN s.tables > 1 THEN ' ' ELSE '' END
        WHEN '/table' THEN CASE WHEN s.tables > 1 THEN ' ' WHEN s.tables = 1 THEN concat({row_end}, {NL2}) ELSE {NL2} END
        ELSE CASE WHEN s.cell THEN CASE t.k WHEN 'pre' THEN {in_cell} ELSE ' ' END ELSE CASE t.k
            WHEN 'li' THEN concat({NL}, {_indent("left(s.kinds, length(s.kinds) - 1)")}, {marker})
            WHEN 'p' THEN CASE WHEN s.kinds = '' THEN {NL2} ELSE '' END
            WHEN '/p' THEN CASE WHEN s.kinds = '' THEN {NL2} ELSE '' END
            WHEN 'h' THEN concat({NL2}, t.v, ' ')
            WHEN '/h' THEN {NL2}
            WHEN 'br' THEN concat({NL}, {_indent('s.kinds')})
            WHEN 'hr' THEN concat({NL2}, '---', {NL2})
            WHEN 'pre' THEN concat({NL2}, {fence}, {NL}, t.v, {NL}, {fence}, {NL2})
            WHEN 'table' THEN {NL2}
            ELSE CASE WHEN length(s.kinds) < CASE WHEN startswith(t.k, '/') THEN 2 ELSE 1 END THEN {NL2} ELSE '' END END END END"""


def _step() -> str:
    """State after token t, whose piece is e."""
    gathered = f"size(s.part) >= {GROUP}"
    last = "size(s.numbers) - 1"
    opened = "CASE WHEN t.k IN ('tr', '/tr', '/table') AND s.tables <= 1 THEN false WHEN t.k = 'td' AND s.tables = 1 THEN true ELSE s.opened END"
    first = "coalesce(cast(nullif(t.v, '') AS int), 1) - 1"
    numbers = f"""CASE t.k WHEN 'ul' THEN array_append(s.numbers, 0) WHEN 'ol' THEN array_append(s.numbers, {first})
        WHEN 'li' THEN CASE WHEN size(s.numbers) = 0 THEN s.numbers
            ELSE array_append(slice(s.numbers, 1, {last}), element_at(s.numbers, -1) + 1) END
        WHEN '/ul' THEN slice(s.numbers, 1, greatest({last}, 0)) WHEN '/ol' THEN slice(s.numbers, 1, greatest({last}, 0)) ELSE s.numbers END"""
    return f"""named_struct(
        'done', CASE WHEN {gathered} THEN array_append(s.done, array_join(s.part, '')) ELSE s.done END,
        'part', CASE WHEN {gathered} THEN array(e) WHEN e = '' THEN s.part ELSE array_append(s.part, e) END,
        'href', CASE t.k WHEN 'a' THEN t.v WHEN '/a' THEN cast(NULL AS string) ELSE s.href END,
        'kinds', CASE t.k WHEN 'ul' THEN concat(s.kinds, 'u') WHEN 'ol' THEN concat(s.kinds, 'o')
            WHEN '/ul' THEN left(s.kinds, length(s.kinds) - 1) WHEN '/ol' THEN left(s.kinds, length(s.kinds) - 1) ELSE s.kinds END,
        'numbers', {numbers},
        'gap', CASE t.k WHEN 't' THEN s.gap AND NOT t.v RLIKE r'\\S' WHEN '/p' THEN s.kinds != '' WHEN 'p' THEN s.gap
            WHEN '/ul' THEN length(s.kinds) > 1 WHEN '/ol' THEN length(s.kinds) > 1 WHEN 'li' THEN false WHEN 'ul' THEN false
            WHEN 'ol' THEN false ELSE s.gap END,
        'tables', CASE t.k WHEN 'table' THEN s.tables + 1 WHEN '/table' THEN greatest(s.tables - 1, 0) ELSE s.tables END,
        'row', CASE WHEN t.k = 'table' AND s.tables = 0 THEN 0 WHEN t.k = 'td' AND s.tables = 1 AND NOT s.opened THEN s.row + 1 ELSE s.row END,
        'cells', CASE WHEN t.k = 'td' AND s.tables = 1 THEN CASE WHEN s.opened THEN s.cells + 1 ELSE 1 END ELSE s.cells END,
        'opened', {opened},
        'cell', CASE WHEN t.k = 'td' AND s.tables = 1 THEN true WHEN t.k IN ('/td', 'tr', '/tr', '/table') AND s.tables <= 1 THEN false ELSE s.cell END)"""


def html_sql(html: str) -> str:
    """SQL text of the Markdown of `html`."""
    start = """named_struct('done', cast(array() AS array<string>), 'part', cast(array() AS array<string>), 'href', cast(NULL AS string),
        'kinds', '', 'numbers', cast(array() AS array<int>), 'gap', false, 'tables', 0, 'row', 0, 'cells', 0, 'opened', false, 'cell', false)"""
    # The piece adds up list numbers after the marker is counted, so the marker's number is the state's next one.
    piece = _piece().replace("element_at(s.numbers, -1)", "element_at(s.numbers, -1) + 1")
    ended = f"""concat(array_join(s.done, ''), array_join(s.part, ''), CASE WHEN s.href IS NULL THEN '' ELSE concat('](', s.href, ')') END,
        CASE WHEN s.cell THEN ' |' ELSE '' END,
        CASE WHEN s.row = 1 AND s.opened THEN concat({NL}, '|', repeat(' --- |', s.cells)) ELSE '' END)"""
    tokens = f"transform(regexp_extract_all({html}, {_text(TOKEN)}, 0), tok -> {_token('tok')})"
    return f"aggregate({tokens}, {start}, (s, t) -> {let('e', piece, _step())}, s -> {ended})"


def html_to_markdown(html: str) -> Column:
    """Markdown of a column of HTML, given by name or as an SQL expression; null stays null."""
    return F.expr(html_sql(html))


def html_title(html: str) -> Column:
    """Text of the title element; null if there is none or it is blank."""
    title = let("title", f"regexp_extract({html}, r'{TITLE}', 1)", references_decoded("title"))
    return F.nullif(strip(F.expr(title)), F.lit(""))
