"""Small document tables and brute-force versions of the corpus operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
#: Columns whose names the operators also use themselves.
CLASHES = "size long, hash long, key string, row int, t string, w string, n long, fp long, component long, tid long, place long, text_hash long"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, rows):
    """Documents (doc_id, text, source) with columns whose names clash."""
    clash = (1, 2, "k", 3, "t", "w", 4, 5, 6, 7, 8, 9)
    full = [(i, t, "en", s, len(t or ""), *clash) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def edge_rows(seed=3):
    """Nulls, empty and blank texts, a long text, few different words, exact and near copies, shared lines and passages."""
    rnd = random.Random(seed)
    base, passage, line = prose(rnd, 120), prose(rnd, 70), "Subscribe to our letter today"
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "One", "b"), (5, base, "b"), (6, base, "b"), (7, " ".join(near), "c"),
        (8, prose(rnd, 40) + " " + passage + " " + prose(rnd, 40), "c"), (9, prose(rnd, 20) + " " + passage + " " + prose(rnd, 60), None),
        (10, "the " * 3000, "d"), (11, prose(rnd, 5000), "d"), (12, base.upper(), "d"), (12, base.upper(), "d"), (None, base, None),
        (None, None, None), (13, "a b c d", "e"), (14, "A b  C d", "e"),
    ]
    rows += [(20 + i, f"{prose(rnd, 60)}\n{'  ' if i % 2 else ''}{line.upper() if i == 3 else line}\n{prose(rnd, 10)}\n", "f") for i in range(5)]
    return rows


def rule_measures(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def line_results(rows, least=20, docs=3):
    holders = defaultdict(set)
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            key = ascii_lower(x.strip(SPACE))
            if len(key) >= least:
                holders[key].add(i)
    rank = lambda i: (i is not None, i or 0)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            held = holders.get(ascii_lower(x.strip(SPACE)), ())
            if len(held) < docs or i == max(held, key=rank):
                kept.append(x)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text):
    w = words(ascii_lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_results(rows):
    sets = {i: shingle_set(t) for i, t, _ in rows if i is not None}
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                head[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeat_results(rows, length):
    where = defaultdict(list)
    raw = [(t or "").encode() for _, t, _ in rows]
    for k, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            where[b[i : i + length]].append((k, i))
    covered = [bytearray(len(b)) for b in raw]
    for places in where.values():
        if len(places) > 1:
            for k, i in places:
                covered[k][i : i + length] = b"\x01" * length
    out = []
    for (i, _, _), b, c in zip(rows, raw, covered, strict=True):
        spans = sum(1 for k in range(len(c)) if c[k] and (k == 0 or not c[k - 1]))
        out.append((i, len(b), sum(c), spans, hashlib.sha256(bytes(x for x, y in zip(b, c, strict=True) if not y)).hexdigest()))
    return out


def in_order(rows):
    return sorted(rows, key=repr)
