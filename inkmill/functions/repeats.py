"""Collapsing a line's first characters where they stand three times in a row.

A token is a prefix of the line of ten characters or more. Longest first, each token that stands three times in a row is
reduced to one at its first such place; shorter tokens are looked for in what is left.

Places are those where the line's first ten characters stand; the reach of a place is the number of characters from there on
that equal the line's first ones. A token of n characters stands three times from p on where p, p + n and p + 2n reach n
or more. Two kinds exist:

* The line does not begin with the token twice. Then p and p + n reach equally far, and neighbour each other among the places
  that reach so far.
* The token is some copies of a word with which the line begins twice. A line has only about log2(length) such words that are
  not copies of a shorter one, and each one's longest run follows from the reaches.

So a search is about linear in the line, however often its beginning recurs. Tokens cut from one line get shorter and shorter,
hence there are at most sqrt(length) searches, and nearly always one or two.
"""

from __future__ import annotations

from inkmill.functions.text import let

MIN_TOKEN_LENGTH, MIN_TOKEN_REPEATS = 10, 3

#: Characters compared in one step.
STRIDE = 16

_NO_NUMBERS = "cast(array() AS array<int>)"


def _alike(one: str, other: str, most: str) -> str:
    """How many characters from place `one` on equal those from the later place `other` on, `most` of them looked at."""
    pairs = f"zip_with(slice(chars, {one} + 1, {most}), slice(chars, {other} + 1, {most}), (u, v) -> coalesce(u = v, false))"
    differing = "cast(array_position(pairs, false) AS int)"
    return let("pairs", pairs, let("differing", differing, "CASE WHEN differing = 0 THEN size(pairs) ELSE differing - 1 END"))


_STARTS = f"""filter(sequence(0, size(chars) - {MIN_TOKEN_LENGTH}), p -> get(chars, p) = get(chars, 0)
    AND slice(chars, p + 1, {MIN_TOKEN_LENGTH}) = slice(chars, 1, {MIN_TOKEN_LENGTH}))"""


def _reaches() -> str:
    """Reach of each of `starts`.

    Where the stretch from place a up to r equals the beginning of the line, its places are those of the beginning, in the same
    order, so their reaches are known up to r. Each step compares a stride beyond that or completes a place. A step copies its
    state, so steps are dealt to rounds, and only a round's own places are part of a step's state.
    """
    like = "s.i - s.a"
    known = f"CASE WHEN {like} < size(o.z) THEN get(o.z, {like}) ELSE get(s.part, {like} - size(o.z)) END"
    begin = f"""CASE WHEN s.k >= 0 THEN s.k WHEN p + {MIN_TOKEN_LENGTH} <= s.r THEN least({known}, s.r - p)
        ELSE {MIN_TOKEN_LENGTH} END"""
    further = "named_struct('i', s.i, 'a', s.a, 'r', s.r, 'part', s.part, 'k', k + more)"
    completed = """named_struct('i', s.i + 1, 'a', CASE WHEN p + k + more > s.r THEN s.i ELSE s.a END,
        'r', greatest(s.r, p + k + more), 'part', array_append(s.part, k + more), 'k', -1)"""
    choice = let("more", _alike("k", "p + k", str(STRIDE)), f"CASE WHEN more = {STRIDE} THEN {further} ELSE {completed} END")
    step = f"""CASE WHEN s.i >= size(starts) THEN s ELSE {let('p', 'get(starts, s.i)', let('k', begin, choice))} END"""
    turn = f"""aggregate(sequence(1, steps), named_struct('i', o.i, 'a', o.a, 'r', o.r, 'part', {_NO_NUMBERS}, 'k', o.k),
        (s, x) -> {step}, s -> named_struct('i', s.i, 'a', s.a, 'r', s.r, 'z', concat(o.z, s.part), 'k', s.k))"""
    start = f"named_struct('i', 1, 'a', 0, 'r', 0, 'z', array_append({_NO_NUMBERS}, size(chars)), 'k', -1)"
    turns = f"aggregate(sequence(0, cast(todo DIV steps AS int)), {start}, (o, y) -> {turn}, o -> o.z)"
    todo = f"size(starts) + size(chars) DIV {STRIDE} + 1"
    return let("todo", f"cast({todo} AS int)", let("steps", "cast(4 + sqrt(todo) AS int)", turns))


def _own_tokens(cap: str) -> str:
    """Longest token below `cap` with which the line does not begin twice; null if there is none."""
    stands = f"""d >= {MIN_TOKEN_LENGTH} AND d <= x.v AND d < {cap}
        AND slice(chars, x.p + 2 * d + 1, d) = slice(chars, 1, d)"""
    apart = let("d", "get(places, i + 1).p - x.p", f"CASE WHEN {stands} THEN d END")
    return f"array_max(transform(places, (x, i) -> CASE WHEN get(places, i + 1).v = x.v THEN {apart} END))"


def _copied_tokens(cap: str) -> str:
    """Longest token below `cap` made of copies of a word with which the line begins twice; null if there is none."""
    short = f"""filter(transform(sequence(1, {MIN_TOKEN_LENGTH - 1}), q ->
        named_struct('q', q, 'z', {_alike('0', 'q', str(MIN_TOKEN_LENGTH))})), w -> w.z >= w.q AND w.z < {MIN_TOKEN_LENGTH})"""
    long = "transform(filter(places, x -> x.p > 0 AND x.v >= x.p), x -> named_struct('q', x.p, 'z', x.v))"
    words = f"""aggregate(sort_array(concat({short}, {long})), cast(array() AS array<struct<q:int,z:int>>), (w, n) ->
        CASE WHEN exists(w, a -> n.q % a.q = 0 AND a.z >= n.q - a.q) THEN w ELSE array_append(w, n) END)"""
    # The line begins with `e` characters of period w.q. Where exactly as many match again, the period may go on; such places
    # then follow each other at distance w.q.
    run = let(
        "many",
        "CASE WHEN x.p - t.last = w.q THEN t.many + 1 ELSE 1 END",
        f"""named_struct('last', x.p, 'many', many, 'best', greatest(t.best,
            (many - 1) * w.q + e + {_alike('x.p + e - w.q', 'x.p + e', 'w.q')}))""",
    )
    longest = f"""aggregate(filter(places, x -> x.v = e AND x.p > 0), named_struct('last', -1 - w.q, 'many', 0, 'best', e),
        (t, x) -> {run}, t -> t.best)"""
    copies = f"cast(w.q * least(e DIV w.q, {longest} DIV w.q DIV {MIN_TOKEN_REPEATS}, ({cap} - 1) DIV w.q) AS int)"
    return f"array_max(transform({words}, w -> {let('e', 'w.q + w.z', copies)}))"


def _next_cut(line: str, cap: str) -> str:
    """The longest token below `cap` that stands three times, and its first such place; null if there is none."""
    places = "sort_array(transform(reaches, (v, i) -> named_struct('v', v, 'p', get(starts, i))))"
    longest = f"greatest({_own_tokens(cap)}, {_copied_tokens(cap)})"
    far = "transform(filter(places, x -> x.v >= token), x -> x.p)"
    back = "transform(far, p -> p - {} * token)"
    first = let("far", far, f"array_min(array_intersect(array_intersect(far, {back.format(1)}), {back.format(2)}))")
    found = f"CASE WHEN token >= {MIN_TOKEN_LENGTH} THEN named_struct('token', token, 'at', {first}) END"
    chosen = let("reaches", _reaches(), let("places", places, let("token", longest, found)))
    enough = f"CASE WHEN size(starts) >= {MIN_TOKEN_REPEATS} THEN {chosen} END"
    return let("chars", f"split({line}, '', -1)", let("starts", _STARTS, enough))


def _may_repeat(line: str) -> str:
    """False only if no token can stand three times. Pieces between places of the line's first characters decide nearly always:
    where those cannot overlap themselves, a token that stands three times leaves two equal pieces."""
    overlaps = f"exists(sequence(1, {MIN_TOKEN_LENGTH - 1}), b -> left(head, b) = right(head, b))"
    pieces = f"slice(split(replace({line}, head, '\n'), '\n', -1), 2, octet_length({line}))"
    alike = let("pieces", pieces, "size(array_distinct(pieces)) < size(pieces)")
    return f"""octet_length({line}) >= {MIN_TOKEN_LENGTH * MIN_TOKEN_REPEATS}
        AND position(left({line}, {MIN_TOKEN_LENGTH}), {line}, {2 * MIN_TOKEN_LENGTH + 1}) > 0
        AND {let('head', f'left({line}, {MIN_TOKEN_LENGTH})', f'({overlaps} OR {alike})')}"""


def collapsed_line(line: str) -> str:
    """SQL for one line (without line feeds) with its repeated tokens reduced to one; longest tokens first."""
    cut = f"""named_struct('cap', found.token, 'line', concat(left(s.line, found.at + found.token),
        substring(s.line, found.at + {MIN_TOKEN_REPEATS} * found.token + 1)))"""
    ended = "named_struct('cap', 0, 'line', s.line)"
    step = let("found", _next_cut("s.line", "s.cap"), f"CASE WHEN found IS NULL THEN {ended} ELSE {cut} END")
    start = f"named_struct('cap', cast(length({line}) DIV {MIN_TOKEN_REPEATS} + 1 AS int), 'line', {line})"
    return f"""CASE WHEN {_may_repeat(line)}
        THEN aggregate(sequence(0, cast(sqrt(length({line})) AS int)), {start},
            (s, x) -> CASE WHEN s.cap <= {MIN_TOKEN_LENGTH} THEN s ELSE {step} END, s -> s.line) ELSE {line} END"""
