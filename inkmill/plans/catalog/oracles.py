"""The same computations as SQL for an independent engine.

Written from the rules, not from the Spark expressions: line runs as gaps and islands, repeats inside lines by shifted
comparison of characters, escalation as a table of independent attempts, CSV from the known cells.
"""

from __future__ import annotations

from inkmill.functions.text import BLANKS, WS, WS_NL

BLANK_CHARS = " || ".join(f"chr({ord(c)})" for c in BLANKS)
FENCE = r"(?s)```[^\n]*\n.*?```|~~~[^\n]*\n.*?~~~"
REPEATED = "repetition detected: same 10+ char string repeated 5+ times"


NO_ENGINE = "no extractor registered for mode ''high_accuracy''"


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# inputs

MARKDOWN = """md AS (SELECT conv_id, turn, raw, strlen(raw)::bigint * (CASE WHEN conv_id % 5 = 0 THEN 201 ELSE 1 END) AS size
FROM (SELECT conv_id, turn,
  '# Turn ' || turn || '  ' || repeat(chr(10), 4) || '##' || chr(10) || '* ' || replace(text, chr(10), chr(10) || '+ ')
  || ' ' || chr(9) || chr(10) || '```txt' || chr(10) || '* keep  ' || chr(10) || '##' || chr(10) || '```' || chr(10) || chr(10)
  || repeat('speaker ' || role || ' said ', (3 + turn % 3)::int) || chr(10)
  || chr(10) || chr(12288) || '+ see ~~~' || chr(10) || turn || chr(10) || '~~~ here' || chr(160) || chr(10) || '###### ' || chr(10)
  AS raw FROM conversations))"""

FILES = """files0 AS (SELECT page_id, url, html,
  ['.html', '.PDF', '.csv', '.jpg', '.tif', '.xyz', '', '.md', '.json', '.docx'][page_id % 10 + 1] AS suffix,
  page_id // 3 AS serial FROM pages),
files1 AS (SELECT page_id, html, 'doc' || serial AS stem, suffix, lower(suffix) AS ext, 'doc' || serial || suffix AS name,
  '/in/' || page_id % 7 || '/doc' || serial || suffix AS path,
  CASE WHEN page_id % 20 = 5 THEN '' WHEN page_id % 20 = 6 THEN url || chr(10) || html
    WHEN page_id % 10 = 2 THEN 'url,id,note' || chr(10) || '"' || url || '",' || page_id || chr(10) || chr(10) || '"a ""b"" | c' || chr(10) || 'd",,,"' || replace(html, '"', '""') || '"' || chr(10)
    WHEN page_id % 10 = 7 THEN '# ' || url || chr(10) || chr(10) || '* first' || chr(10) || '+ second  ' || chr(10) || html
    WHEN page_id % 10 = 8 THEN '{"id": ' || page_id || ', "url": "' || url || '", "html": "'
      || replace(replace(replace(replace(html, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(9), '\\t') || '"}'
    ELSE html END AS text, url FROM files0),
files AS (SELECT *, strlen(text)::bigint AS size FROM files1)"""

# The known cells of the CSV files; the last record is the widest.
CSV_PAGE = r"""'| url | id | note |  |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) || '| ' || url || ' | ' || page_id || ' |  |  |' || chr(10)
  || '| a "b" \| c d |  |  | ' || replace(replace(html, chr(10), ' '), '|', '\|') || ' |'"""

MODES = """ext_modes AS (SELECT unnest(['.pdf','.docx','.doc','.pptx','.ppt','.xlsx','.xls','.csv','.html','.htm','.json','.xml','.epub','.zip','.txt','.md','.rst']) AS ext, 'standard' AS mode
UNION ALL SELECT unnest(['.jpg','.jpeg','.png','.gif','.webp','.bmp','.tif','.tiff']), 'paddle_ocr'),
overrides AS (SELECT * FROM (VALUES ('.tif', 'ocr'), ('.md', 'high_accuracy'), ('.PDF', 'ocr')) AS t(ext, mode))"""

MIME = r"""CASE WHEN text = '' THEN NULL
  WHEN regexp_matches(text, '(?i)^\s*<(!doctype\s+html|html)\b') THEN 'text/html'
  WHEN starts_with(text, '<?xml') THEN 'application/xml'
  WHEN (starts_with(text, '{') OR starts_with(text, '[')) AND json_valid(text) THEN 'application/json'
  ELSE 'text/plain' END"""


def routed(overrides: bool) -> str:
    first = "o.mode, " if overrides else ""
    return MODES + f""",
routed AS (SELECT f.*, coalesce({first}e.mode, CASE WHEN {MIME.replace('text ', 'f.text ')} IS NOT NULL THEN 'standard' END, 'unknown') AS mode
FROM files f LEFT JOIN ext_modes e ON e.ext = f.ext LEFT JOIN overrides o ON o.ext = f.ext)"""


def _entities(text: str) -> str:
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


def _html(text: str) -> str:
    steps = [
        (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>", "''"),
        (r"(?is)<head\b.*?</head\s*>", "''"),
    ]
    steps += [(rf"(?i)<h{n}\b[^>]*>", f"chr(10) || chr(10) || '{'#' * n} '") for n in range(1, 7)]
    steps += [
        (r"(?i)<li\b[^>]*>", "chr(10) || '* '"),
        (r"""(?is)<a\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]*)[^>]*>(.*?)</a\s*>""", r"'[\2](\1)'"),
        (r"(?i)<br\b[^>]*>", "chr(10)"),
        (
            r"(?i)</?(?:p|div|ul|ol|article|nav|footer|header|section|main|table|tr|blockquote|pre)\b[^>]*>|</h[1-6]\s*>",
            "chr(10) || chr(10)",
        ),
        (r"(?i)</?[a-z!][^>]*>", "''"),
    ]
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, '{pattern}', {replacement}, 'g')"
    return _entities(text)


def _title(text: str) -> str:
    inner = f"regexp_extract({text}, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1)"
    return f"nullif(trim({_entities(inner)}, {BLANK_CHARS}), '')"


# Pages by window functions: depth of lists, the link that is open, and one piece of text for each token.
HTML_TOKENS = rf"""WITH cut AS (SELECT page_id, regexp_extract_all(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>|<head\b.*?</head\s*>|</?[a-z!][^>]*>|[^<]+|<') AS toks FROM pages),
tok AS (SELECT page_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM cut),
named AS (SELECT *, CASE WHEN tok[1] != '<' OR tok = '<' THEN 'text' WHEN regexp_matches(tok, '(?is)^<(!|(script|style|title|head)\b.*</)') THEN 'none'
    ELSE lower(regexp_extract(tok, '^<(/?[a-zA-Z][a-zA-Z0-9]*)', 1)) END AS name,
    regexp_extract(tok, '(?i)\bhref\s*=\s*["'']?([^"''\s>]*)', 1) AS href FROM tok),
open AS (SELECT *, sum(CASE name WHEN 'ul' THEN 1 WHEN '/ul' THEN -1 ELSE 0 END) OVER w AS depth,
    last_value(CASE name WHEN 'a' THEN href WHEN '/a' THEN '' END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS link
    FROM named WINDOW w AS (PARTITION BY page_id ORDER BY pos)),
pieces AS (SELECT page_id, pos, CASE
    WHEN name = 'text' THEN {_entities('tok')}
    WHEN regexp_matches(name, '^h[1-6]$') THEN chr(10) || chr(10) || repeat('#', name[2]::int) || ' '
    WHEN name = 'li' THEN chr(10) || repeat('  ', greatest(depth - 1, 0)::int) || '* '
    WHEN name = 'a' THEN CASE WHEN coalesce(link, '') != '' THEN '](' || {_entities('link')} || ')' ELSE '' END || CASE WHEN href != '' THEN '[' ELSE '' END
    WHEN name = '/a' THEN CASE WHEN coalesce(link, '') != '' THEN '](' || {_entities('link')} || ')' ELSE '' END
    WHEN name = 'br' THEN chr(10)
    WHEN regexp_matches(name, '^/(h[1-6])$') THEN chr(10) || chr(10)
    WHEN name IN ('ul', '/ul') THEN CASE WHEN depth = (name = 'ul')::int THEN chr(10) || chr(10) ELSE '' END
    WHEN ltrim(name, '/') IN ('p', 'div', 'article', 'nav', 'footer', 'header', 'section', 'main') THEN chr(10) || chr(10)
    ELSE '' END AS piece FROM open)
SELECT '/tiers/' || page_id || '.htm' AS path, coalesce(string_agg(piece, '' ORDER BY pos), '') AS raw_md FROM pages LEFT JOIN pieces USING (page_id) GROUP BY page_id"""


# normalization

TOKEN = "'__CODEBLOCK_' || substr(md5((i - 1)::varchar || b), 1, 12) || printf('%08x', i - 1) || substr(md5((i - 1)::varchar || b), 13, 12) || '__'"


def _hidden(text: str) -> str:
    """Text whose blocks (b) have been replaced by their tokens."""
    tokens = f"list_transform(regexp_extract_all({text}, '{FENCE}'), lambda b, i: {TOKEN})"
    pieces = f"string_split_regex({text}, '{FENCE}')"
    return f"array_to_string(list_transform(list_zip({pieces}, {tokens}), lambda z: z[1] || coalesce(z[2], '')), '')"


def _trailing(text: str) -> str:
    return rf"regexp_replace({text}, '[{WS}]+(\n|\z)', '\1', 'g')"


def _newlines(text: str) -> str:
    return rf"regexp_replace({text}, '\n{{3,}}', chr(10) || chr(10), 'g')"


def _bullets(text: str) -> str:
    return rf"regexp_replace({text}, '(?m)^([{WS}]*)[*+]([{WS}]+)', '\1-\2', 'g')"


def _without_empty_headings(text: str) -> str:
    return f"list_filter(string_split({text}, chr(10)), lambda l: NOT regexp_full_match(l, '#{{1,6}}[{WS}]*'))"


COLLAPSED = """CASE WHEN length(l) >= 30 AND instr(substr(l, 21), left(l, 10)) > 0 THEN
  list_reduce(list_transform(range((length(l) // 3)::int, 9, -1), lambda n: n::varchar), lambda acc, n:
    CASE WHEN instr(acc, repeat(left(acc, n::int), 3)) = 0 THEN acc
    ELSE left(acc, (instr(acc, repeat(left(acc, n::int), 3)) - 1 + n::int)::int) || substr(acc, (instr(acc, repeat(left(acc, n::int), 3)) + 3 * n::int)::int) END, l)
  ELSE l END"""


def _collapsed(source: str, keys: str, lines: str, target: str) -> str:
    """CTEs that collapse repeats in the list column `lines` of `source` and join the lines again as `body`."""
    on = " AND ".join(f"s.{k} = r.{k}" for k in keys.split(", "))
    return f"""{target}_l AS (SELECT {keys}, unnest({lines}) AS l, generate_subscripts({lines}, 1) AS pos FROM {source}),
{target}_r AS (SELECT {keys}, string_agg({COLLAPSED}, chr(10) ORDER BY pos) AS body FROM {target}_l GROUP BY ALL),
{target} AS (SELECT s.*, coalesce(r.body, '') AS body FROM {source} s LEFT JOIN {target}_r r ON {on})"""


def _normalized(source: str, keys: str, text: str, target: str) -> str:
    """CTEs that add `clean` to `source`."""
    restored = f"""list_reduce(list_transform(range(1, len(blocks) + 1), lambda n: n::varchar),
      lambda acc, n: replace(acc, tokens[n::int], blocks[n::int]), trim(body, {BLANK_CHARS}))"""
    return f"""{target}_b AS (SELECT *, regexp_extract_all({text}, '{FENCE}') AS blocks FROM {source}),
{target}_t AS (SELECT *, list_transform(blocks, lambda b, i: {TOKEN}) AS tokens,
  {_without_empty_headings(_bullets(_newlines(_trailing(_hidden(text)))))} AS kept FROM {target}_b),
{_collapsed(f"{target}_t", keys, "kept", f"{target}_c")},
{target} AS (SELECT *, CASE WHEN {text} IS NULL THEN NULL WHEN len(blocks) = 0 THEN trim(body, {BLANK_CHARS}) ELSE {restored} END AS clean FROM {target}_c)"""


# validation


def _headings(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '(?m)^#{{1,6}}[{WS_NL}]+[^{WS_NL}]'))::int"


def _line_runs(source: str, keys: str, text: str, target: str) -> str:
    """CTE of the keys of texts with five equal, long enough neighbouring lines."""
    kept = f"list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '[^{WS}]'))"
    return f"""{target}_l AS (SELECT {keys}, unnest({kept}) AS l, generate_subscripts({kept}, 1) AS pos FROM {source}),
{target}_g AS (SELECT *, CASE WHEN l = lag(l) OVER (PARTITION BY {keys} ORDER BY pos) THEN 0 ELSE 1 END AS starts FROM {target}_l),
{target}_i AS (SELECT *, sum(starts) OVER (PARTITION BY {keys} ORDER BY pos) AS island FROM {target}_g),
{target} AS (SELECT DISTINCT {keys} FROM (SELECT {keys}, island FROM {target}_i WHERE length(l) >= 10 GROUP BY ALL HAVING count(*) >= 5))"""


def _inner_repeats(source: str, keys: str, text: str, target: str) -> str:
    """CTE of the keys of texts with a line that equals itself shifted by k >= 10 over a stretch of 4k characters.

    Such a stretch covers four multiples of k in a row. Lines where the characters at those agree for some k are looked
    at closer: the three blocks between them must agree as a whole, and then some start must give the full stretch. Lines settled by
    their first candidate are not looked at again.
    """
    anchors = " AND ".join(f"c[(j + {i}) * k + 1] = c[(j + {i + 1}) * k + 1]" for i in range(4))
    hits = f"list_filter(range(0, (n - 1) // k - 3), lambda j: {anchors})"

    def stretch(candidates: str) -> str:
        return f"""SELECT DISTINCT l FROM (SELECT l, k, unnest(range(greatest((j - 1) * k, 0), j * k + 1)) AS s FROM ({candidates}))
  WHERE length(substr(l, (s + k + 1)::int, (4 * k)::int)) = 4 * k
  AND substr(l, (s + 1)::int, (4 * k)::int) = substr(l, (s + k + 1)::int, (4 * k)::int)"""

    pairs = f"flatten(list_transform(range(10, n // 5 + 1), lambda k: list_transform({hits}, lambda j: [k, j])))"
    return f"""{target}_l AS (SELECT {keys}, unnest(string_split({text}, chr(10))) AS l FROM {source}),
{target}_d AS MATERIALIZED (SELECT l, length(l)::bigint AS n FROM (SELECT DISTINCT l FROM {target}_l WHERE length(l) >= 50 AND regexp_matches(l, '[^{WS}]'))),
{target}_c AS MATERIALIZED (SELECT l, n, c FROM (SELECT l, n, string_split(l, '') AS c FROM {target}_d)
  WHERE len(list_filter(range(10, n // 5 + 1), lambda k: len({hits}) > 0)) > 0),
{target}_p AS MATERIALIZED (SELECT l, p[1] AS k, p[2] AS j FROM (SELECT l, unnest({pairs}) AS p FROM {target}_c)),
{target}_b AS MATERIALIZED (SELECT * FROM {target}_p WHERE substr(l, (j * k + 1)::int, (3 * k)::int) = substr(l, ((j + 1) * k + 1)::int, (3 * k)::int)),
{target}_e AS MATERIALIZED ({stretch(f"SELECT l, min(k) AS k, arg_min(j, (k, j)) AS j FROM {target}_b GROUP BY l")}),
{target}_f AS (SELECT l FROM {target}_e UNION ({stretch(f"SELECT * FROM {target}_b ANTI JOIN {target}_e USING (l)")})),
{target} AS (SELECT DISTINCT {keys} FROM {target}_l SEMI JOIN {target}_f USING (l))"""


def _flagged(source: str, keys: str, text: str, target: str) -> str:
    return ",\n".join(
        (
            _line_runs(source, keys, text, f"{target}_runs"),
            _inner_repeats(source, keys, text, f"{target}_reps"),
            f"{target} AS (SELECT {keys} FROM {target}_runs UNION SELECT {keys} FROM {target}_reps)",
        )
    )


def _validated(source: str, keys: str, text: str, target: str, min_ratio: str = "0.01") -> str:
    """CTEs that add the checks to `source`, which has a column size."""
    on = " AND ".join(f"s.{k} = f.{k}" for k in keys.split(", "))
    first_key = keys.split(", ")[0]
    return f"""{_flagged(source, keys, text, f"{target}_flag")},
{target}_m AS (SELECT s.*, length({text})::int AS char_count, {_headings(text)} AS heading_count,
  f.{first_key} IS NOT NULL AS repetition_flag, CASE WHEN size > 0 THEN length({text}) / size END AS ratio
  FROM {source} s LEFT JOIN {target}_flag f ON {on}),
{target}_r AS (SELECT *, CASE WHEN char_count = 0 THEN ['empty output: char_count=0'] ELSE list_filter([
    CASE WHEN char_count < 50 THEN 'char_count=' || char_count || ' < min=50' END,
    CASE WHEN repetition_flag THEN '{REPEATED}' END,
    CASE WHEN ratio < {min_ratio} THEN 'extraction_ratio=' || printf('%.4f', ratio) || ' < min={min_ratio}' END
  ], lambda r: r IS NOT NULL) END AS reasons FROM {target}_m),
{target} AS (SELECT *, CASE WHEN char_count IS NOT NULL THEN len(reasons) = 0 END AS passed, array_to_string(reasons, '; ') AS failure_reasons,
  round(ratio, 6) AS extraction_ratio,
  CASE WHEN char_count > 0 AND heading_count = 0 THEN 'no headings found in output' ELSE '' END AS warnings FROM {target}_r)"""


CHECKS = "passed, char_count, heading_count, repetition_flag, extraction_ratio, failure_reasons, warnings"
TEXTS = "texts AS (SELECT doc_id, text, strlen(text)::bigint AS size FROM documents)"


# escalation: every mode tried on every page, then cut after the first one that passes

TIERS = f"""tiers AS (SELECT page_id, '/tiers/' || page_id || '.htm' AS path, page_id || '.htm' AS name, html, strlen(html)::bigint AS size,
  CASE WHEN page_id % 10 = 7 THEN 1 ELSE 0 END AS first FROM pages),
modes AS (SELECT * FROM (VALUES (0, 'standard'), (1, 'paddle_ocr'), (2, 'ocr'), (3, 'high_accuracy')) AS t(step, mode)),
tried AS (SELECT path, name, html, size, first, step, mode, step - first AS attempt,
  path || '#' || step AS try_id,
  CASE step WHEN 0 THEN array_to_string(paragraphs, chr(10) || chr(10))
    WHEN 1 THEN array_to_string(list_concat(headings, paragraphs), chr(10) || chr(10))
    WHEN 2 THEN {_html('html')} END AS raw,
  CASE WHEN step = 3 THEN '{NO_ENGINE}' END AS error
  FROM (SELECT *, regexp_extract_all(html, '(?is)<p>(.*?)</p>', 1) AS paragraphs,
    regexp_extract_all(html, '(?is)<h[1-6]\\b[^>]*>(.*?)</h[1-6]\\s*>', 1) AS headings FROM tiers) CROSS JOIN modes WHERE step >= first),
{_normalized('tried', 'try_id', 'raw', 'tclean')},
{_validated('tclean', 'try_id', 'clean', 'tried_all', '0.7')}"""

ATTEMPTS = f"""{TIERS},
cut AS (SELECT *, coalesce(max(passed::int) OVER (PARTITION BY path ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over FROM tried_all),
made AS (SELECT * FROM cut WHERE over = 0),
ended AS (SELECT path, any_value(name) AS name, any_value(html) AS html, any_value(size) AS size, max(attempt)::int AS retry_count,
  arg_min(mode, attempt) AS selected_mode, CASE WHEN max(attempt) > 0 THEN arg_max(mode, attempt) END AS escalated_to,
  bool_or(coalesce(passed, false)) AS success,
  arg_max(raw, attempt) FILTER (raw IS NOT NULL) AS raw_md, arg_max(clean, attempt) FILTER (raw IS NOT NULL) AS clean_md,
  arg_max(struct_pack(passed, char_count, heading_count, repetition_flag, extraction_ratio, failure_reasons, warnings, reasons), attempt) FILTER (raw IS NOT NULL) AS v,
  arg_max(error, attempt) FILTER (error IS NOT NULL) AS last_error FROM made GROUP BY path),
outcome AS (SELECT *, CASE WHEN success THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN NOT success THEN list_concat(CASE WHEN last_error IS NULL THEN [] ELSE [last_error] END, coalesce(v.reasons, [])) END AS failures FROM ended)"""

ERROR = "array_to_string(failures, '; ')"

# batch runs

DOC_FILES = "docfiles AS (SELECT doc_id, '/docs/' || source || '/' || doc_id || '.txt' AS path, doc_id || '.txt' AS name, text, strlen(text)::bigint AS size FROM documents)"

DOC_RUN = f"""{DOC_FILES},
{_normalized('docfiles', 'doc_id', 'text', 'dclean')},
{_validated('dclean', 'doc_id', 'clean', 'dval')},
docrun AS (SELECT *, CASE WHEN passed THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN NOT passed THEN '{NO_ENGINE}; ' || failure_reasons END AS error FROM dval)"""


def _file_run(skip: str) -> str:
    """Files through the default modes: only the standard mode has an extractor, and only for text formats."""
    return f"""{FILES}, {routed(False)},
flagged AS (SELECT *, mode <> 'unknown' AND ({skip}) AS skip FROM routed),
first_text AS (SELECT *, CASE WHEN skip OR mode <> 'standard' OR ext IN ('.pdf', '.docx') THEN NULL
  WHEN ext = '.html' OR (ext NOT IN ('.csv', '.md', '.json') AND {MIME} = 'text/html') THEN {_html('text')}
  WHEN ext = '.csv' THEN {CSV_PAGE}
  ELSE text END AS raw FROM flagged),
{_normalized('first_text', 'page_id', 'raw', 'fclean')},
{_validated('fclean', 'page_id', 'clean', 'fval')},
filerun AS (SELECT *, CASE WHEN mode = 'unknown' THEN 'failed' WHEN skip THEN 'skipped' WHEN passed THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN mode = 'unknown' THEN 'unsupported file type: ' || suffix WHEN skip OR passed THEN NULL
    ELSE '{NO_ENGINE}' || CASE WHEN raw IS NULL THEN '' ELSE '; ' || failure_reasons END END AS error FROM fval)"""


# The first path of a stem that gives text has the stem; those after it are skipped.
_STEM_RUN = _file_run("stem IN (SELECT stem FROM files WHERE page_id % 7 = 0)") + """,
stemrun AS (SELECT * REPLACE (CASE WHEN later THEN 'skipped' ELSE status END AS status, CASE WHEN later THEN NULL ELSE error END AS error)
  FROM (SELECT *, mode <> 'unknown' AND coalesce(path > (SELECT min(o.path) FROM filerun o WHERE o.stem = filerun.stem AND o.raw IS NOT NULL), false) AS later
    FROM filerun))"""


def _md(select: str) -> str:
    return _with(MARKDOWN, select=f"SELECT conv_id, turn, {select} AS out FROM md")


ORACLES: dict[str, str] = {
    "path_parts": _with(FILES, select="SELECT path, name, stem, suffix, ext, size FROM files"),
    "stem_dedup": _with(FILES, select="SELECT path, stem, row_number() OVER (PARTITION BY stem ORDER BY path) = 1 AS is_first FROM files"),
    "skip_existing": _with(FILES, select="SELECT path, stem FROM files WHERE page_id % 7 <> 0"),
    "skip_existing_stem": _with(
        FILES, select="SELECT path, stem FROM files WHERE stem NOT IN (SELECT stem FROM files WHERE page_id % 7 = 0)"
    ),
    "route_ext": _with(FILES, MODES, select="SELECT path, f.ext, mode FROM files f LEFT JOIN ext_modes e ON e.ext = f.ext"),
    "route_override": _with(FILES, MODES, select="SELECT path, f.ext, mode FROM files f LEFT JOIN overrides o ON o.ext = f.ext"),
    "sniff_mime": _with(
        FILES, f"m AS (SELECT path, {MIME} AS mime FROM files)",
        select="SELECT path, mime, CASE WHEN mime IS NOT NULL THEN 'standard' END AS mode FROM m",
    ),
    "sniff_bytes": """SELECT page_id, (strlen(html) + [8, 4, 8, 6, 12, 4, 4, 6, 23, 0][page_id % 10 + 1])::int AS size,
      ['application/pdf', 'image/jpeg', 'image/png', 'image/gif', 'image/webp', 'image/bmp', 'image/tiff', 'application/zip',
       'application/zip', NULL][page_id % 10 + 1] AS mime FROM pages""",
    # The kinds of packages in order; those cut short have lost their directory, but an EPUB shows at its beginning.
    "sniff_packages": """SELECT page_id, cut, CASE WHEN cut AND page_id % 5 < 4 THEN 'application/zip' ELSE
      ['application/vnd.openxmlformats-officedocument.wordprocessingml.document', 'application/zip',
       'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet',
       'application/vnd.openxmlformats-officedocument.presentationml.presentation', 'application/epub+zip'][page_id % 5 + 1] END AS mime
      FROM pages, (VALUES (false), (true)) AS c(cut)""",
    "route": _with(FILES, routed(True), select="SELECT path, mode FROM routed"),
    "route_unknown": _with(
        FILES, routed(False),
        select="SELECT path, 'failed' AS status, 'unsupported file type: ' || suffix AS error FROM routed WHERE mode = 'unknown'",
    ),
    "extract_standard": _with(
        FILES,
        f"kinds AS (SELECT *, CASE WHEN ext IN ('.pdf', '.docx') THEN 'none' WHEN ext = '.csv' THEN 'csv' WHEN ext = '.html' OR (ext NOT IN ('.md', '.json') AND {MIME} = 'text/html') THEN 'html' ELSE 'text' END AS kind FROM files)",
        select=f"""SELECT path, CASE kind WHEN 'html' THEN {_html('text')} WHEN 'text' THEN text
          WHEN 'csv' THEN {CSV_PAGE} END AS raw_md,
          CASE WHEN kind = 'html' THEN {_title('text')} END AS title,
          CASE WHEN kind = 'none' THEN 'no extractor registered for ' || ext END AS extract_error FROM kinds""",
    ),
    "extract_text": "SELECT '/docs/' || source || '/' || doc_id || '.txt' AS path, text AS raw_md, NULL::varchar AS title FROM documents",
    "extract_html": HTML_TOKENS,
    # The known parts of the pages.
    "extract_html_structure": r"""SELECT conv_id, turn, chr(10) || chr(10) || '## Turn ' || turn || repeat(chr(10), 4)
      || chr(10) || (turn + 1) || '. ' || role || chr(10) || chr(10) || '   * ' || split_part(text, chr(10), 1) || chr(10) || chr(10) || '   * deep …'
      || chr(10) || (turn + 2) || '. one' || chr(10) || '   two' || chr(10) || chr(10)
      || chr(10) || chr(10) || '```' || chr(10) || text || chr(10) || '```' || chr(10) || chr(10)
      || chr(10) || chr(10) || chr(10) || '| turn | text |' || chr(10) || '| --- | --- |' || chr(10)
      || '| ' || turn || ' | ' || replace(regexp_replace(text, '\s*\n\s*', ' ', 'g'), '|', '\|') || ' |' || chr(10) || chr(10) AS raw_md
      FROM conversations""",
    "decode_references": "SELECT doc_id, coalesce(text, '') || '&lt;’—…&unknown;\ufffd–''&' AS out FROM documents",
    "decode_text": """SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 1) THEN 'UTF-8' WHEN doc_id % 5 = 2 THEN 'UTF-16LE' WHEN doc_id % 5 = 3 THEN 'UTF-16BE'
        WHEN strlen(latin) = length(latin) THEN 'UTF-8' ELSE 'windows-1252' END AS charset,
      CASE doc_id % 5 WHEN 3 THEN 'Plain letters come first. ' || text WHEN 4 THEN latin ELSE text END AS out
      FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[^\\x{0}-\\x{ff}]', '?', 'g') AS latin FROM documents)""",
    "extract_title": f"SELECT '/tiers/' || page_id || '.htm' AS path, {_title('html')} AS title FROM pages",
    "extract_csv": """SELECT conv_id, turn, '| turn | role | text |  |' || chr(10) || '| --- | --- | --- | --- |' || chr(10)
      || '| ' || turn || ' | ' || role || ' | ' || replace(replace(replace(text, 'é', '"'), chr(10), ' '), '|', '\\|') || ' |  |' || chr(10)
      || '| ' || turn || ' | a\\|b |  | kept |' AS raw_md FROM conversations""",
    "ocr_lines_to_md": f"""SELECT conv_id, turn, array_to_string(list_filter(list_transform(list_filter(
      regexp_extract_all(text, '[^.\\n]*'), lambda l: NOT starts_with(l, 'L')), lambda l: trim(l, {BLANK_CHARS})), lambda l: l <> ''),
      chr(10) || chr(10)) AS raw_md FROM conversations""",
    "extract_errors": _with(
        FILES, routed(False),
        select="""SELECT path, mode, CASE WHEN mode = 'paddle_ocr' THEN 'no extractor registered for mode ''paddle_ocr'''
          WHEN mode = 'standard' AND ext IN ('.pdf', '.docx') THEN 'no extractor registered for ' || ext END AS error FROM routed""",
    ),
    "protect_code": _md(_hidden("raw")),
    "strip_trailing": _md(_trailing("raw")),
    "collapse_blank": _md(_newlines("raw")),
    "unify_bullets": _md(_bullets("raw")),
    "drop_empty_headings": _md(f"array_to_string({_without_empty_headings('raw')}, chr(10))"),
    "collapse_repeats": _with(
        MARKDOWN, "split AS (SELECT conv_id, turn, string_split(raw, chr(10)) AS lines FROM md)",
        _collapsed("split", "conv_id, turn", "lines", "done"), select="SELECT conv_id, turn, body AS out FROM done",
    ),
    "strip_doc": _md(f"trim(raw, {BLANK_CHARS})"),
    # Spaces outside the blocks were replaced.
    "restore_code": _with(
        MARKDOWN,
        select=f"""SELECT conv_id, turn, array_to_string(list_transform(list_zip(string_split_regex(raw, '{FENCE}'), regexp_extract_all(raw, '{FENCE}')),
          lambda z: replace(z[1], ' ', '_') || coalesce(z[2], '')), '') AS out FROM md""",
    ),
    "normalize_all": _with(TEXTS, _normalized("texts", "doc_id", "text", "done"), select="SELECT doc_id, clean AS clean_md FROM done"),
    "normalize_markdown": _with(
        MARKDOWN, _normalized("md", "conv_id, turn", "raw", "done"), select="SELECT conv_id, turn, clean AS out FROM done"
    ),
    "char_count": "SELECT doc_id, length(text)::int AS char_count FROM documents",
    "heading_count": _with(MARKDOWN, select=f"SELECT conv_id, turn, {_headings('raw')} AS heading_count FROM md"),
    "line_runs": _with(
        _line_runs("documents", "doc_id", "text", "f"),
        select="SELECT doc_id, doc_id IN (SELECT doc_id FROM f) AS flag FROM documents",
    ),
    "substring_repeats": _with(
        _inner_repeats("documents", "doc_id", "text", "f"),
        select="SELECT doc_id, doc_id IN (SELECT doc_id FROM f) AS flag FROM documents",
    ),
    "repetition_flag": _with(
        _flagged("documents", "doc_id", "text", "f"),
        select="SELECT doc_id, doc_id IN (SELECT doc_id FROM f) AS flag FROM documents",
    ),
    "extraction_ratio": _with(
        MARKDOWN,
        select="SELECT conv_id, turn, round(CASE WHEN turn % 5 <> 0 AND turn % 3 <> 0 THEN length(raw) / size END, 6) AS ratio FROM md",
    ),
    "validate_empty": _with(
        FILES, _validated("files", "path", "text", "done"),
        select="""SELECT path, passed, char_count, ratio AS extraction_ratio, failure_reasons AS reasons,
          (warnings <> '')::int AS n_warnings FROM done""",
    ),
    "validate_short": "SELECT doc_id, CASE WHEN length(text) < 50 AND text <> '' THEN 'char_count=' || length(text) || ' < min=50' END AS reason FROM documents",
    "validate_warnings": _with(
        MARKDOWN, _normalized("md", "conv_id, turn", "raw", "n"), _validated("n", "conv_id, turn", "clean", "done"),
        select="SELECT conv_id, turn, warnings FROM done",
    ),
    "validate_all": _with(
        TEXTS, _normalized("texts", "doc_id", "text", "n"), _validated("n", "doc_id", "clean", "done"),
        select=f"SELECT doc_id, {CHECKS} FROM done",
    ),
    "validate_markdown": _with(
        MARKDOWN, _normalized("md", "conv_id, turn", "raw", "n"), _validated("n", "conv_id, turn", "clean", "done"),
        select=f"SELECT conv_id, turn, {CHECKS} FROM done",
    ),
    "next_mode": _with(
        FILES, routed(True),
        "chain AS (SELECT mode, lead(mode) OVER (ORDER BY pos) AS next_mode FROM (VALUES (1, 'standard'), (2, 'paddle_ocr'), (3, 'ocr'), (4, 'high_accuracy')) AS t(pos, mode))",
        select="SELECT path, r.mode, next_mode FROM routed r LEFT JOIN chain c ON c.mode = r.mode",
    ),
    "escalate": _with(
        ATTEMPTS,
        select=f"SELECT path, status, selected_mode, escalated_to, retry_count, raw_md, clean_md, {ERROR} AS error FROM outcome",
    ),
    "attempt_summary": _with(
        TIERS,
        select="""SELECT path, arg_min(mode, attempt) AS selected_mode, CASE WHEN max(attempt) > 0 THEN arg_max(mode, attempt) END AS escalated_to,
          max(attempt)::int AS retry_count, arg_max(char_count, attempt) FILTER (raw IS NOT NULL) AS char_count,
          arg_max(failure_reasons, attempt) FILTER (raw IS NOT NULL) AS reasons, arg_max(error, attempt) FILTER (error IS NOT NULL) AS error
          FROM tried_all GROUP BY path""",
    ),
    "attempts_made": _with(
        ATTEMPTS,
        select="""SELECT path, attempt::int AS attempt, mode, passed, char_count,
          CASE WHEN passed IS NOT NULL THEN failure_reasons END AS reasons, error FROM made""",
    ),
    "failed_docs": _with(
        ATTEMPTS,
        select=f"SELECT path, len(failures)::int AS n_reasons, {ERROR} AS error, raw_md IS NOT NULL AS has_raw FROM outcome WHERE status = 'failed'",
    ),
    "quarantine": _with(
        ATTEMPTS,
        select=f"SELECT name AS input_file, length(html)::int AS payload_length, length(clean_md)::int AS clean_length, {ERROR} AS failure_reasons FROM outcome WHERE status = 'failed'",
    ),
    "conversion_log": _with(
        ATTEMPTS,
        select=f"""SELECT path AS input_file, size AS input_size_bytes, '.htm' AS detected_type, selected_mode, escalated_to, retry_count,
          CASE WHEN raw_md IS NOT NULL THEN path END AS output_raw, CASE WHEN success THEN path END AS output_clean, 1.235::double AS duration_seconds,
          status, {ERROR} AS error, v.passed, v.char_count, v.heading_count, v.repetition_flag, v.extraction_ratio, v.failure_reasons, v.warnings FROM outcome""",
    ),
    "log_json": _with(
        ATTEMPTS,
        select=f"""SELECT to_json(struct_pack(input_file := path, input_size_bytes := size, detected_type := '.htm', selected_mode := selected_mode,
          escalated_to := escalated_to, retry_count := retry_count, output_raw := CASE WHEN raw_md IS NOT NULL THEN path END,
          output_clean := CASE WHEN success THEN path END, validation := struct_pack(passed := v.passed, char_count := v.char_count,
          heading_count := v.heading_count, repetition_flag := v.repetition_flag, failure_reasons := v.reasons,
          warnings := CASE WHEN v.warnings = '' THEN []::varchar[] ELSE [v.warnings] END), duration_seconds := 1.235::double, status := status, error := {ERROR}))::varchar AS json FROM outcome""",
    ),
    "convert_batch": _with(
        DOC_RUN,
        select="""SELECT path, 'standard' AS selected_mode, status, CASE WHEN passed THEN 0 ELSE 3 END::int AS retry_count, error, char_count,
          md5(text) AS raw_md5, md5(clean) AS clean_md5 FROM docrun""",
    ),
    "convert_files": _with(
        _STEM_RUN,
        select="""SELECT path, mode AS selected_mode, status, CASE WHEN status = 'failed' AND mode <> 'unknown' THEN 'high_accuracy' END AS escalated_to,
          CASE WHEN status = 'failed' AND mode = 'standard' THEN 3 WHEN status = 'failed' AND mode = 'paddle_ocr' THEN 2 ELSE 0 END::int AS retry_count, error FROM stemrun""",
    ),
    "batch_summary": _with(
        _STEM_RUN,
        select="SELECT count(*) AS total, count_if(status = 'success')::bigint AS success, count_if(status = 'failed')::bigint AS failed, count_if(status = 'skipped')::bigint AS skipped FROM stemrun",
    ),
    "document_summary": _with(
        DOC_RUN,
        select="SELECT count(*) AS total, count_if(passed)::bigint AS success, count_if(NOT passed)::bigint AS failed, 0::bigint AS skipped FROM docrun",
    ),
    "batch_failed": _with(DOC_RUN, select="SELECT name AS file, status, error FROM docrun WHERE status = 'failed'"),
    "outcome_rates": _with(
        _file_run("false"),
        select="""SELECT ext, mode, count(*) AS documents, round(avg((status = 'success')::int), 6) AS success_rate,
          round(avg(coalesce(passed, false)::int), 6) AS pass_rate, 1.0::double AS log_rate FROM filerun GROUP BY ext, mode""",
    ),
}
