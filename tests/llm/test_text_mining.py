"""Chat formatting, lexical search and collocations: edge cases and brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkmill.llm import chat, collocations, lexical, wordstream
from tests.llm.samples import ascii_lower, edge_rows, frame, in_order, prose

PIECES = st.sampled_from(
    ["\\", "\\\\", "### User: ", "### Assistant: ", "### =x%20: ", "</turn>", "\n", "\n</turn>\n", "### ", "<", "é", "a", ": ", "User"]
)
ROLE_NAMES = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", "", "Assistant", "a b", "=", "x:\n", "é"]), st.text(max_size=5))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE_NAMES, st.lists(PIECES, max_size=8).map("".join)), max_size=4))
def test_chat_turns_read_back(turns):
    text = "".join(chat.rendered(role, body) for role, body in turns)
    assert chat.recovered(text) == turns


def test_only_conflicting_content_is_escaped():
    assert chat.rendered("user", "a \\ b ### c") == "### User: a \\ b ### c\n</turn>\n"
    assert chat.rendered("assistant", chat.PLANTED) == "### Assistant: \\\\### Assistant: \\</turn> ok\n</turn>\n"
    for broken in ("x", "### User: a", "### User: a</turn>\n", "### User: ### User: \n</turn>\n"):
        with pytest.raises(chat.Malformed):
            chat.parsed(broken)


def chat_by_force(rows):
    conversations = {}
    order = lambda v: (v is not None, v)
    for conv, turn, role, text in sorted(rows, key=lambda r: (order(r[0]), order(r[1]), r[2] or "", r[3] or "")):
        conversations.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, turns in conversations.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        learnt = "".join(t for r, t in turns if r == "assistant")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, learnt)]
        out.append((conv, len(turns), digests[0], len(learnt), digests[1], sum(len(chat.rendered(r, t)) for r, t in turns)))
    return in_order(out)


@pytest.fixture
def many_tasks(spark):
    """Small tables stay in as many tasks as they are dealt to."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_chat_conversations(spark, many_tasks):
    rnd = random.Random(5)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, None, None, "first")]
    rows += [(None, 2, "user", "no id"), (None, 1, "assistant", "at all"), (2, 0, "odd role", "</turn>"), (3, 0, "assistant", "")]
    rows += [(7, i, rnd.choice(["user", "assistant"]), prose(rnd, 5) + rnd.choice(["", "\\", "\n</turn>\n"])) for i in range(3000)]  # hot
    rows += [(100 + i // 3, i % 3, "assistant", prose(rnd, 4)) for i in range(300)] + [(4, 0, "assistant", "é" * 3_000_000)]
    turns = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "conv_id long, turn long, role string, text string, block long, part string, closed boolean")
    blocks = chat.formatted(turns).collect()
    whole = {}
    for b in sorted(blocks, key=lambda b: (b.part, b.block)):
        whole.setdefault(b.conv_id, []).append(b.text)
    assert len(whole[7]) > 1  # spread over tasks
    assert "".join(t for _, t in chat.recovered("".join(whole[1]))) == "firsthibb"
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    found = in_order(map(tuple, chat.digests(chat.formatted(turns)).select(*names).collect()))
    assert found == chat_by_force(rows)
    assert chat.digests(chat.formatted(turns.limit(0))).count() == 0


def ranked_by_force(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(t or ""))
    held = [(i, Counter(w), len(w)) for i, t, *_ in docs if (w := terms(t))]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c, n in held:
            m = 100 - 25 + 25 * n * n_docs // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, q in wanted.items() if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return in_order(out)


def test_lexical_search(spark, monkeypatch):
    rnd = random.Random(8)
    vocabulary = [prose(rnd, 1).replace(" ", "") + str(i) for i in range(60)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 80))), "s") for i in range(400)]
    docs += [(1000 + i, docs[3][1], "s") for i in range(50)] + edge_rows()  # ties; nulls, long texts, repeated rows and ids
    items = [(i, " ".join(rnd.choices(vocabulary, k=8))) for i in range(12)]
    items += [(20, None), (21, " .,"), (22, "nowhere"), (None, vocabulary[0]), (3, vocabulary[5].upper()), (23, docs[3][1])]
    asked = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, term string, rank int")
    table = frame(spark, docs)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(lexical, "SUMMED", 7)
    want = ranked_by_force(docs, items, 7)
    found = in_order((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(table, asked, 7).collect())
    assert found == want
    assert lexical.ranked(table.limit(0), asked, 7).count() == 0 == lexical.ranked(table, asked.limit(0), 7).count()


def test_signature_bounds_never_lie_below_scores():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(1, 200))) for _ in range(300)]
    blocks, terms, found = lexical._signatures(pa.array(texts))
    assert dict(zip(terms, found.tolist(), strict=True)) == {t: sum(t in lexical.terms_of(x) for x in texts) for t in terms}
    asked = lexical.Asked([(i % 4, t, 7 + i) for i, t in enumerate(terms)], len(texts), sum(len(lexical.terms_of(t)) for t in texts))
    seen = 0
    for members, sizes, width, bits in blocks:
        for d, row, size in zip(members.tolist(), asked.bounds(sizes, width, bits), sizes.tolist(), strict=True):
            counts, m = Counter(lexical.terms_of(texts[d])), asked.lengths([size])[0]
            scores = [asked.score(i, counts, m) for i in range(4)]
            assert all(b >= s for b, s in zip(row.tolist(), scores, strict=True))
            seen += 1
    assert seen == 300


def phrases_by_force(rows, least, most, share):
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", ascii_lower(text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                count.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    often = {g: a for g, a in count.items() if len(g) > 2 and a >= least}
    out = {}
    for (lang, *w), a in often.items():
        if len(w) == 2 and any(g[0] == lang and len(g) == 4 and 100 * f >= share * a and w in ([*g[1:3]], [*g[2:]]) for g, f in often.items()):
            continue
        cuts = [(10**6 * a * a // (count[lang, *w[:k]] * count[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), count[lang, *w[:k]], count[lang, *w[k:]]))
    found = [
        (lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, left, r) in enumerate(sorted(x)[:most])
    ]
    return in_order(found)


def test_collocations(spark, monkeypatch, many_tasks):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["the", "the", "of", "a", "Été", "x\x00y", "d\u00a0e", "q", "r", "s-t"])
    rows = [(rnd.choice(["en", "en", "fr", None, "und", "x\ny"]), "".join(word() + rnd.choice(" \t.,\n  ") for _ in range(60))) for _ in range(150)]
    # A third of all words in one pair, with many different words behind it.
    rows += [("en", " ".join(f"hot pair w{rnd.randrange(400)}" for _ in range(2000))), ("en", None), ("en", ""), (None, ". ,"), ("fr", "ONE two" * 3)]
    docs = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "lang string, text string, route int, word string, count double").repartition(5)
    monkeypatch.setattr(collocations, "SMALL", 3)
    monkeypatch.setattr(wordstream, "PART_BYTES", 300)
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    found = in_order(tuple(r[c] for c in names) for r in collocations.collocations(docs, 4, 30, 50).collect())
    assert found == phrases_by_force(rows, 4, 30, 50)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 10**15
    rows = spark.createDataFrame([(big, big + 7, big + 9), (3, 5, 7)], "a long, l long, r long")
    found = [r.s for r in rows.select(F.expr(collocations._score("a", "l", "r")).alias("s")).collect()]
    assert found == [10**6 * a * a // (x * y) for a, x, y in ((big, big + 7, big + 9), (3, 5, 7))]


def test_quicksort_counts_what_a_plain_count_does():
    rng = np.random.default_rng(1)
    columns = [rng.integers(1, 30, 20_000), rng.integers(1, 5, 20_000), rng.integers(0, 8, 20_000)]
    weights = rng.integers(1, 4, 20_000)
    count = Counter()
    for a, b, c, w in zip(*columns, weights, strict=True):
        count[int(a), int(b), 0] += int(w)
        if c:
            count[int(a), int(b), int(c)] += int(w)
    want = {g: f for g, f in count.items() if f >= 60}
    found = {}
    for rows, sizes in collocations.quicksorted(columns, weights, 60):
        for r, s in zip(rows.tolist(), sizes.tolist(), strict=True):
            assert tuple(r) not in found
            found[tuple(r)] = s
    assert found == want
