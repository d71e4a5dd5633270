r"""Chat formatting with a grammar round trip.

A turn is written as `### Role: `, the text, a line feed and `</turn>`. The roles system, user, assistant and tool have a title;
any other role is written as `=` and its percent-encoded name. Headers and `</turn>` are the control strings: one with a
backslash right before it is text. Rendering starts from the text as it is, reparses the turn with the deterministic parser
and compares what comes back; only where that differs from the source is the conflicting content escaped, by one more
backslash before each control string in it, and the turn parsed again. Reading back takes that backslash off.

Conversations are written as blocks of whole turns: rows are partitioned by range of conversation and turn and sorted, so one
conversation may be spread over many tasks, and a block never holds more than about a million characters unless a single turn
does. Nearly every conversation is one block. The blocks of a conversation, in order, are its formatted text.

Defined results: a null text or role counts as empty; rows of a conversation go by turn (nulls first), then role, then text, so
repeated rows are repeated turns; rows without conv_id are one conversation; an empty table gives no conversation. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.llm.common import saved, whole_text

TITLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
ROLES = {title: role for role, title in TITLES.items()}
END = "\n</turn>\n"
_HEADER = rf"### ({'|'.join(ROLES)}|=[0-9A-Za-z_.~%-]*): "
HEADER = re.compile(_HEADER)
CONTROL = re.compile(rf"{_HEADER}|</turn>")
ESCAPED = re.compile(rf"\\(?=### (?:{'|'.join(ROLES)}|=[0-9A-Za-z_.~%-]*): |</turn>)")
LEARNT = "assistant"
#: Characters of a block, unless one turn is longer.
BLOCK_CHARS = 1 << 20


class Malformed(ValueError):
    """The text is not a sequence of turns."""


def header(role: str) -> str:
    return f"### {TITLES.get(role) or '=' + quote(role, safe='')}: "


def escaped(text: str) -> str:
    return CONTROL.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub("", text)


def parsed(text: str) -> list[tuple[str, int, int]]:
    """Role, first and last place of the (still escaped) body of every turn."""
    turns, at = [], 0
    while at < len(text):
        head = HEADER.match(text, at)
        if not head:
            raise Malformed(f"no header at {at}")
        for mark in CONTROL.finditer(text, head.end()):
            if text[mark.start() - 1] != "\\":
                break
        else:
            raise Malformed(f"no end of the turn at {at}")
        stop = mark.start() - 1
        if mark[0] != "</turn>" or stop < head.end() or not text.startswith(END, stop):
            raise Malformed(f"control string inside the turn at {at}")
        role = head[1]
        turns.append((unquote(role[1:]) if role.startswith("=") else ROLES[role], head.end(), stop))
        at = stop + len(END)
    return turns


def recovered(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn, read back."""
    return [(role, unescaped(text[a:b])) for role, a, b in parsed(text)]


def rendered(role: str, text: str) -> str:
    """One turn: the text as it is if that reads back as the source, else escaped until it does."""
    for body in (text, escaped(text)):
        turn = f"{header(role)}{body}{END}"
        try:
            if recovered(turn) == [(role, text)]:
                return turn
        except Malformed:
            pass
    raise Malformed(f"a turn of {role!r} does not read back as its source")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks of whole turns of sorted rows: conv_id, closed, n_turns, text and the places under the loss mask."""
    current, first, only = None, True, True
    pieces, length, loss = [], 0, []

    def block(closed: bool) -> tuple:
        return current, closed, len(pieces), "".join(pieces), loss

    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if pieces and conv != current:
                # The first conversation of a task may have begun in another one.
                yield block(only and not first)
                pieces, length, loss, first, only = [], 0, [], False, True
            elif pieces and length + len(text) > BLOCK_CHARS:
                yield block(False)
                pieces, length, loss, only = [], 0, [], False
            current = conv
            turn = rendered(role, text)
            if role == LEARNT:
                start = length + len(header(role))
                loss.append({"start": start, "stop": length + len(turn) - len(END)})
            pieces.append(turn)
            length += len(turn)
    if pieces:
        yield block(False)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, part and block (the order of a conversation's blocks), closed, n_turns, text, loss (start and stop of the
    stretches under the loss mask).

    `closed` blocks are surely whole conversations; the others may have neighbours in other tasks.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), whole_text().alias("text"))
    schema = T.StructType([
        rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in ("part", "block")),
        T.StructField("closed", T.BooleanType()), T.StructField("n_turns", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, form = TaskContext.get().partitionId(), None
        kept = []

        def keep(batches):
            nonlocal form
            for batch in batches:
                form = form or batch.schema.field("conv_id").type
                yield batch

        def flush() -> pa.RecordBatch:
            conv, closed, n, text, loss = zip(*(k[1] for k in kept), strict=True)
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(conv, form), pa.array([part] * len(kept), pa.int64()), pa.array([k[0] for k in kept], pa.int64()),
                    pa.array(closed, pa.bool_()), pa.array(n, pa.int64()), pa.array(text, pa.string()), pa.array(loss, span),
                ],
                names=schema.names,
            )

        held = 0
        for number, block in enumerate(_blocks(keep(batches))):
            kept.append((number, block))
            held += len(block[3])
            if held > BLOCK_CHARS:
                yield flush()
                kept, held = [], 0
        if kept:
            yield flush()

    order = ("conv_id", "turn", "role")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").drop("turn").mapInArrow(run, schema)


def _content(text: str, loss: list[dict]) -> tuple[bytes, str]:
    """What the formatted text says: role and text of each turn, and the text under the loss mask."""
    turns = "".join(f"{role}\n{body}\n" for role, body in recovered(text)).encode()
    return turns, "".join(unescaped(text[s["start"] : s["stop"]]) for s in loss)


def digests(blocks: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from formatted blocks.

    Blocks are read back where they are; only conversations that may lie in several blocks pass their content on, and hashing,
    which has to go in order, is all that is left to do for them.
    """
    counts = [T.StructField(c, T.LongType()) for c in ("n_turns", "loss_chars", "formatted_chars")]
    texts = [T.StructField(c, T.StringType()) for c in ("turns_sha256", "loss_sha256")]
    opened = [T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("closed", T.BooleanType())]
    bodies = [T.StructField(c, T.BinaryType()) for c in ("turns", "loss")]
    conv = blocks.schema["conv_id"]
    read_schema = T.StructType([conv, *opened, *counts, *texts, *bodies])
    done_schema = T.StructType([conv, *counts, *texts])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").to_pylist()
            closed = batch.column("closed").to_pylist()
            found = [_content(*x) for x in zip(text, batch.column("loss").to_pylist(), strict=True)]
            loss = [x[1].encode() for x in found]
            digest = lambda values: pa.array(
                [hashlib.sha256(v).hexdigest() if c else None for v, c in zip(values, closed, strict=True)], pa.string()
            )
            rest = lambda values: pa.array([None if c else v for v, c in zip(values, closed, strict=True)], pa.binary())
            turns = [x[0] for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "part", "block", "closed", "n_turns")),
                    pa.array([len(x[1]) for x in found], pa.int64()), pa.array([len(t) for t in text], pa.int64()),
                    digest(turns), digest(loss), rest(turns), rest(loss),
                ],
                names=read_schema.names,
            )

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per conversation of sorted rows."""
        current, state, form = None, None, None

        def row() -> pa.RecordBatch:
            n, hashes = state
            values = [current, *n, *(h.hexdigest() for h in hashes)]
            types = [form, *[pa.int64()] * 3, *[pa.string()] * 2]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=done_schema.names)

        for batch in batches:
            form = batch.schema.field("conv_id").type
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != current:
                    if state is not None:
                        yield row()
                    current, state = r["conv_id"], ([0, 0, 0], (hashlib.sha256(), hashlib.sha256()))
                for i, field in enumerate(counts):
                    state[0][i] += r[field.name]
                state[1][0].update(r["turns"])
                state[1][1].update(r["loss"])
        if state is not None:
            yield row()

    found = saved(blocks.mapInArrow(read, read_schema))
    whole = found.filter("closed").select(*done_schema.names)
    parts = found.filter("NOT closed").drop("closed", "turns_sha256", "loss_sha256").repartition("conv_id")
    return whole.unionByName(parts.sortWithinPartitions("conv_id", "part", "block").mapInArrow(chained, done_schema))


PLANTED = r"\### Assistant: </turn> ok"


def query(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], turns.schema)
    done = digests(formatted(turns.unionByName(planted)))
    return done.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, length('### ') + CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN length(role) ELSE 1 + length(url_encode(role)) END
    + length(': ') + length(text) + length(chr(10) || '</turn>' || chr(10))
    + len(regexp_extract_all(text, '### (?:System|User|Assistant|Tool|=[0-9A-Za-z_.~%-]*): |</turn>')) AS chars
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id
"""
