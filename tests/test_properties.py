"""Random documents against plain-Python expectations."""

import random

from inkmill.functions import normalize as N
from inkmill.functions import validate as V
from inkmill.settings import Normalization, Validation
from tests import expectations as E

PIECES = [
    "a", "bc", " ", "  ", "\t", "\n", "\n\n", "\n\n\n\n", "\r", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003",
    "\u2028", "\u3000", "# ", "## ", "#", "####### x", "* ", "+ ", "*", "**b**", "- ", "```", "~~~", "```py\n",
    "\n```\n", "~~~\n* x  \n~~~", "한글 문서 ", "😀", "$1\\", "hello world! ", "abcdefghij", "0123456789AB",
    "__CODEBLOCK_", "speaker one said ", "ab ",
]


def documents(seed, count):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(0, 14)):
            piece = rng.choice(PIECES)
            if rng.random() < 0.35:
                piece = piece * rng.randint(2, 7)
            parts.append(piece)
        text = "".join(parts)
        if rng.random() < 0.2:
            text = (text.replace("\n", " ") * rng.randint(2, 6))[rng.randint(0, 9) :]
        if rng.random() < 0.1:
            text = "\n".join([text.replace("\n", "")] * rng.randint(2, 6))
        out.append(text)
    return out


def test_normalize_matches_rules(evaluate):
    texts = documents(1, 3000)
    assert evaluate(N.normalize, texts) == [E.normalized(t) for t in texts]


def test_normalize_with_other_options(evaluate):
    texts = documents(2, 800)
    options = Normalization(bullet_char="$1\\*", max_consecutive_newlines=1)
    assert evaluate(lambda t: N.normalize(t, options), texts) == [E.normalized(t, "$1\\*", 1) for t in texts]


def test_headings_match_rules(evaluate):
    texts = documents(3, 2000)
    assert evaluate(V.heading_count, texts) == [E.headings(t) for t in texts]


def test_repetition_matches_rules(evaluate):
    texts = documents(4, 3000)
    assert evaluate(V.repeated_lines, texts) == [E.line_run(t) for t in texts]
    found = evaluate(V.repeated_inside_line, texts)
    assert found == [E.inner_repeat(t) for t in texts]
    assert 100 < sum(found) < 2900


def test_repetition_with_other_thresholds(evaluate):
    rng = random.Random(5)
    texts = []
    for _ in range(1200):
        unit = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 9)))
        noise = "".join(rng.choice("ab \n") for _ in range(rng.randint(0, 25)))
        texts.append(noise + unit * rng.randint(1, 6) + noise[::-1])
    for shortest, copies in ((10, 5), (4, 3), (3, 2), (1, 1), (2, 4), (10, 2), (6, 1)):
        options = Validation(repetition_min_length=shortest, max_repetition_count=copies)
        assert evaluate(lambda t: V.repeated_inside_line(t, options), texts) == [
            E.inner_repeat(t, shortest, copies) for t in texts
        ], (shortest, copies)
        assert evaluate(lambda t: V.repeated_lines(t, options), texts) == [
            E.line_run(t, shortest, copies) for t in texts
        ], (shortest, copies)


def test_long_lines_stay_exact(evaluate):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    sentence = " ".join(rng.choice(words) for _ in range(40))
    prose = [" ".join(rng.choice(words) for _ in range(700)) for _ in range(2)]
    dense = ["".join(rng.choice("αβγδε😀") for _ in range(1500)) for _ in range(2)]
    block = "".join(rng.choice("αβγδε😀") for _ in range(70))
    texts = prose + dense
    texts += [p + " " + (sentence + " ") * 5 + p for p in prose] + [p + (sentence + " ") * 4 + p for p in prose]
    texts += [d + block * 5 + d for d in dense] + [d + block * 4 + d for d in dense]
    texts += [sentence + p + sentence * 4 + p for p in prose]
    assert evaluate(V.repeated_inside_line, texts) == [E.inner_repeat(t) for t in texts]
    assert evaluate(N.collapse_repeats, texts) == [E.collapse_line(t) for t in texts]


def test_lines_whose_beginning_recurs(evaluate):
    rng = random.Random(9)
    texts = ["", "a" * 29, "a" * 30, "a" * 95]
    for _ in range(1500):
        letters = rng.choice(["a", "ab", "abc", "é😀b", "abcdefghij "])
        line = "".join(rng.choice(letters) for _ in range(rng.randint(1, 25)))
        for _ in range(rng.randint(0, 5)):
            begin = rng.randint(0, len(line))
            end, k = min(len(line), begin + rng.randint(0, 40)), rng.randint(1, 30)
            line = rng.choice(
                [
                    line + line[begin:end] * rng.randint(1, 4),
                    line[:end] * rng.randint(1, 3) + line[begin:],
                    line + line[:k] * 3 + rng.choice(letters),
                    line[:k] * rng.randint(2, 9) + line,
                ]
            )[:300]
        texts.append(line)
    assert evaluate(N.collapse_repeats, texts) == [E.collapse_line(t) for t in texts]


def test_many_starts_in_a_long_line(evaluate):
    rng = random.Random(10)

    def filler(size):
        return "".join(rng.choice("bcdfgh ") for _ in range(size))

    head = "start here"
    spaced = "".join(head + filler(990) for _ in range(80))
    dense = "".join(head + filler(rng.randint(1, 4)) + "!" for _ in range(4000))
    assert evaluate(N.collapse_repeats, [spaced, spaced + head * 3, dense, "ab" * 20000]) == [
        spaced,
        spaced + head,
        E.collapse_line(dense),
        E.collapse_line("ab" * 20000),
    ]


def test_documents_table(spark):
    rows = (
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        .select("text", N.normalize("text").alias("clean"))
        .select("text", "clean", V.repeated_lines("clean").alias("lines"))
        .collect()
    )
    assert [r.clean for r in rows] == [E.normalized(r.text) for r in rows]
    assert [r.lines for r in rows] == [E.line_run(r.clean) for r in rows]
