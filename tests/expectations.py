"""Plain-Python statements of the rules, written for clarity and used as the expected side of property tests."""

import hashlib
import re


def collapse_line(line):
    """A line equals itself shifted by n where copies of n characters follow each other: three need 2n equal places."""
    for n in range(len(line) // 3, 9, -1):
        if line[:n] not in line[n:]:
            continue
        run, hit = 0, None
        for i in range(len(line) - n - 1, -1, -1):
            run = run + 1 if line[i] == line[i + n] else 0
            if run >= 2 * n and line.startswith(line[:n], i):
                hit = i
        if hit is not None:
            line = line[: hit + n] + line[hit + 3 * n :]
    return line


def fenced(text):
    """Text and blocks in turn, by one scan over the places where a fence may open."""
    pieces, begin, i = [], 0, 0
    while i < len(text):
        fence = text[i : i + 3]
        feed = text.find("\n", i + 3) if fence in ("```", "~~~") else -1
        close = text.find(fence, feed + 1) if feed >= 0 else -1
        if close < 0:
            i += 1
            continue
        pieces += [text[begin:i], text[i : close + 3]]
        begin = i = close + 3
    return [*pieces, text[begin:]]


def normalized(text, bullet="-", most=2):
    if not text:
        return text
    pieces = fenced(text)
    blocks = pieces[1::2]
    marks = [f"__CODEBLOCK_{hashlib.md5(repr((i, text)).encode()).hexdigest()}__" for i in range(len(blocks))]
    pieces[1::2] = marks
    body = "\n".join(x.rstrip() for x in "".join(pieces).split("\n"))
    body = re.sub("\n{%d,}" % (most + 1), "\n" * most, body)
    lines = [re.sub(r"\A(\s*)[*+](?=\s)", lambda m: m[1] + bullet, x) for x in body.split("\n")]
    body = "\n".join(collapse_line(x) for x in lines if not re.fullmatch(r"#{1,6}\s*", x)).strip()
    for mark, block in zip(marks, blocks):
        body = body.replace(mark, block)
    return body


def line_run(text, shortest=10, copies=5):
    kept = [x for x in text.split("\n") if x.strip()]
    run = 1
    for before, this in zip(kept, kept[1:]):
        run = run + 1 if this == before and len(this) >= shortest else 1
        if run >= max(copies, 2):
            return True
    return False


def inner_repeat(text, shortest=10, copies=5):
    """Length of equality runs between the line and itself shifted by the token length."""
    for line in text.split("\n"):
        if not line.strip() or len(line) < shortest * copies:
            continue
        for size in range(shortest, len(line) // copies + 1):
            run = 0
            need = (copies - 1) * size
            if need == 0:
                return True
            for a, b in zip(line, line[size:]):
                run = run + 1 if a == b else 0
                if run >= need:
                    return True
    return False


def headings(text):
    return len(re.findall(r"(?m)^#{1,6}\s+\S", text))
