"""Quality checks on clean Markdown as column expressions. Arguments are column names or any SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.text import WS_NL, has_ink, let, lines, sql_text
from inkmill.settings import Validation

# Wording of reasons and warnings.
EMPTY_REASON = "empty output: char_count=0"
NO_HEADING_WARNING = "no headings found in output"

RESULT_TYPE = (
    "struct<passed:boolean,char_count:int,heading_count:int,repetition_flag:boolean,extraction_ratio:double,"
    "failure_reasons:array<string>,warnings:array<string>>"
)


def _heading_count(text: str) -> str:
    marks = f"regexp_count({text}, r'(?md)^#{{1,6}}[{WS_NL}]+[^{WS_NL}]')"
    return f"CASE WHEN contains({text}, '#') THEN {marks} WHEN {text} IS NOT NULL THEN 0 END"


def _inked_lines(text: str) -> str:
    return f"filter({lines(text)}, line -> {has_ink('line')})"


def _repeated_lines(kept: str, options: Validation) -> str:
    # A run needs two equal neighbours, whatever the threshold.
    run = max(options.max_repetition_count, 2)
    rest = f"forall(sequence(i + 2, i + {run - 1}), j -> get({kept}, j) = get({kept}, i))" if run > 2 else "true"
    return f"""(size({kept}) >= {run} AND exists(sequence(0, greatest(size({kept}) - {run}, 0)), i ->
        get({kept}, i) = get({kept}, i + 1) AND length(get({kept}, i)) >= {options.repetition_min_length} AND {rest}))"""


def _periodic(units: str, separator: str, options: Validation) -> str:
    """Some token, `max_repetition_count` times back to back, lies in the text whose split into `units` is given.

    With period k (in units), such a stretch makes units equal that lie k apart, and it is long enough to cover several
    multiples of k in a row. Testing only those multiples costs about n ln n comparisons over all k, and almost none
    of them gets past the first. What does is then decided exactly on the characters around it.
    """
    copies, shortest = options.max_repetition_count, options.repetition_min_length
    whole = copies if separator == "" else copies - 1  # equal anchors guaranteed inside the stretch

    # Characters from one period before the anchor to where a stretch around it must end. The stretch has that
    # period if comparing the characters with those one token later gives a long enough unbroken run.
    start = "greatest(at - k, 0)"
    window = f"array_join(slice({units}, {start} + 1, at + {copies + 1} * k - {start}), '{separator}')"
    overlap = "size(c) - token"
    same = f"zip_with(slice(c, 1, {overlap}), slice(c, token + 1, {overlap}), (x, y) -> IF(x = y, '=', ' '))"
    run = f"exists(split(array_join({same}, ''), ' '), r -> octet_length(r) >= {copies - 1} * token)"
    stretch = f"exists(array(split({window}, '')), c -> {overlap} > 0 AND {run})"
    token = f"length(array_join(slice({units}, at + 1, k), '{separator}')) + {len(separator)}"
    inner = f"{copies - 2} * k"
    # A few units settle most cases before whole blocks are compared.
    near = [f"forall(sequence(0, least(32, {inner}) - 1), d -> get({units}, at + d) = get({units}, at + k + d))"] if copies > 2 else []
    confirmed = f"""exists(array({token}), token -> token >= {shortest}
        AND slice({units}, at + 1, {inner}) = slice({units}, at + k + 1, {inner}) AND {stretch})"""

    anchors = [f"get({units}, at + {i} * k) = get({units}, at + {i + 1} * k)" for i in range(whole - 1)]
    # The first comparison settles nearly all cases, so it is kept as short as can be.
    anchors[:1] = [f"get({units}, at) = get({units}, at + k)"] if anchors else []
    last = f"cast((size({units}) - 1) DIV k AS int) - {whole - 1}"
    with_period = f"""{last} >= 0 AND exists(sequence(0, greatest({last}, 0) * k, k), at ->
        {' AND '.join([*anchors, *near, confirmed])})"""

    longest = f"cast((size({units}) + {len(separator)}) DIV {copies} AS int)"
    # On characters the token length is the period itself.
    first = shortest if separator == "" else 1
    return f"({longest} >= {first} AND exists(sequence({first}, greatest({longest}, {first})), k -> {with_period}))"


def _repeated_inside(line: str, options: Validation) -> str:
    needed = options.max_repetition_count * options.repetition_min_length
    long_enough = f"octet_length({line}) >= {needed} AND length({line}) >= {needed}"
    if options.max_repetition_count == 1:
        return f"({long_enough})"
    # A repeated token either holds a space, and so repeats words, or lies within one word.
    in_word = f"""exists(words, word -> octet_length(word) >= {needed}
        AND exists(array(split(word, '')), chars -> {_periodic('chars', '', options)}))"""
    by_word = f"exists(array(split({line}, ' ', -1)), words -> {in_word} OR {_periodic('words', ' ', options)})"
    return f"({long_enough} AND {by_word})"


def _repetition_flag(text: str, options: Validation) -> str:
    inside = f"exists(kept, line -> {_repeated_inside('line', options)})"
    return f"exists(array({_inked_lines(text)}), kept -> {_repeated_lines('kept', options)} OR {inside})"


def _extraction_ratio(text: str, size: str) -> str:
    return f"CASE WHEN {size} > 0 THEN length({text}) / {size} END"


def _failure_reasons(count: str, repeated: str, ratio: str, options: Validation) -> str:
    repetition = (
        f"repetition detected: same {options.repetition_min_length}+ char string "
        f"repeated {options.max_repetition_count}+ times"
    )
    return f"""array_compact(array(
        CASE WHEN {count} < {options.min_char_count} THEN concat('char_count=', {count}, ' < min={options.min_char_count}') END,
        CASE WHEN {repeated} THEN {sql_text(repetition)} END,
        CASE WHEN {ratio} < {options.min_extraction_ratio}D
            THEN concat('extraction_ratio=', {_four_digits(ratio)}, ' < min={options.min_extraction_ratio}') END))"""


def _four_digits(ratio: str) -> str:
    """The ratio with four decimals, rounded from its exact binary value, half to even.

    Java's formatter rounds the shortest decimal form half up, which differs only where that form ends in a 5 at the
    fifth decimal (t hundred-thousandths). There, m / 2^k, the exact value, is compared with t / 100000 in integers.
    """
    two_to_k = "cast(shiftleft(1L, k DIV 2) AS decimal(19,0)) * cast(shiftleft(1L, k - k DIV 2) AS decimal(19,0))"
    m, middle = f"cast(cast({ratio} * pow(2, k) AS bigint) AS decimal(19,0)) * 100000", f"cast(t AS decimal(18,0)) * {two_to_k}"
    downwards = let(
        "k", f"cast(54 - floor(log2({ratio})) AS int)", f"{m} < {middle} OR ({m} = {middle} AND (t DIV 10) % 2 = 0)"
    )
    cut = "concat(t DIV 100000, '.', lpad(cast((t DIV 10) % 10000 AS string), 4, '0'))"
    return let(
        "t",
        f"cast(round({ratio} * 100000) AS bigint)",
        f"CASE WHEN t % 10 = 5 AND t / 100000 = {ratio} AND {downwards} THEN {cut} ELSE format_string('%.4f', {ratio}) END",
    )


def char_count(text: str) -> Column:
    return F.expr(f"length({text})")


def heading_count(text: str) -> Column:
    """Heading marks followed by a title; the blanks between them may span lines."""
    return F.expr(_heading_count(text))


def inked_lines(text: str) -> Column:
    """Lines that are not blank."""
    return F.expr(_inked_lines(text))


def repeated_lines(text: str, options: Validation = Validation()) -> Column:
    """Enough equal, long enough lines in a row, blank lines left out."""
    return F.expr(f"exists(array({_inked_lines(text)}), kept -> {_repeated_lines('kept', options)})")


def repeated_inside_line(text: str, options: Validation = Validation()) -> Column:
    """Some long enough token occurs often enough back to back inside one line."""
    return F.expr(f"exists({_inked_lines(text)}, line -> {_repeated_inside('line', options)})")


def repetition_flag(text: str, options: Validation = Validation()) -> Column:
    return F.expr(_repetition_flag(text, options))


def extraction_ratio(text: str, size: str) -> Column:
    """Characters per input byte; null when the size is unknown or not positive."""
    return F.expr(_extraction_ratio(text, size))


def validate(text: str, size: str, options: Validation = Validation()) -> Column:
    """All checks, packed in a struct. Empty text fails at once and skips the others."""
    none = "cast(array() AS array<string>)"

    def result(passed: str, count: str, headings: str, repeated: str, ratio: str, reasons: str, warnings: str) -> str:
        return f"""named_struct('passed', {passed}, 'char_count', {count}, 'heading_count', {headings},
            'repetition_flag', {repeated}, 'extraction_ratio', {ratio}, 'failure_reasons', {reasons},
            'warnings', {warnings})"""

    measures = f"""named_struct('count', length({text}), 'headings', {_heading_count(text)},
        'repeated', {_repetition_flag(text, options)}, 'ratio', {_extraction_ratio(text, size)})"""
    warnings = f"CASE WHEN m.headings = 0 THEN array('{NO_HEADING_WARNING}') ELSE {none} END"
    judged = let(
        "reasons",
        _failure_reasons("m.count", "m.repeated", "m.ratio", options),
        result("size(reasons) = 0", "m.count", "m.headings", "m.repeated", "m.ratio", "reasons", warnings),
    )
    empty = result("false", "0", "0", "false", _extraction_ratio(text, size), f"array('{EMPTY_REASON}')", none)
    return F.expr(
        f"""cast(CASE WHEN length({text}) = 0 THEN {empty}
            WHEN {text} IS NOT NULL THEN {let('m', measures, judged)} END AS {RESULT_TYPE})"""
    )
