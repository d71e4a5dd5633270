"""Exact substring deduplication: bytes covered by a string of `length` bytes that also starts elsewhere.

Suffixes are sampled by content: of the grams (strings of GRAM bytes) in every `length` bytes of text, the one with the least
hash is an anchor. Two equal strings of that length hold the same anchor at the same place, so every repeat shows as two equal
anchors, and about one byte in 150 is one. A suffix array here is a written table of the anchors' suffixes, ordered by the hash
of their first GRAM bytes, partitioned by range.

The arrays form a logarithmic family. A new batch of texts gets its own array, which is scanned against itself and against each
existing level for anchors that occur twice; then arrays over equally many batches merge into one of the next level. So a batch
is compared with few tables, and every anchor is rewritten about log2(batches) times.

Only anchors that occur twice are looked at in the text. Their surroundings (all strings of `length` bytes that hold the
anchor) are compared with each other by suffix order on both sides: a string is repeated if another anchor agrees with it that
far to the left and to the right. An anchor that very many texts share is not compared in one place; its strings are divided by
where they lie around the anchor, and counted by hash, down to single strings where some are repeated and some are not.

Defined results: a null text is empty; texts shorter than `length` lose nothing; copies of a whole text lose all of it; rows
that repeat an id are judged by their texts, one row each; a null id stays null; an empty table gives an empty result. Other
columns are ignored. Texts are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import saved, whole_text
from inkmill.llm.lookup import id_bits, passing, placed
from inkmill.llm.shingles import mixed

LENGTH, GRAM, BATCHES = 400, 100, 4
#: Anchors that occur more often than this are counted by hash instead of being compared in one place. Compared in one place,
#: each takes about 700 bytes and as much again for the padded rows, so that a task stays below 100 MB.
HOT = 32_768
#: Into how many parts the strings around a hot anchor are divided at each step.
PARTS = 7

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_UNIT = np.uint64(_BASE)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers; the longest row asked for is kept."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = _POWERS[int(base)] = np.multiply.accumulate(known)
    return known[:n]


class Rolling:
    """Hashes of any substring of a text from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_UNIT, n), dtype=np.uint64)))
        self.back = _powers(_BACK, n + 1)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every `width` neighbouring values lies, leftmost first; each place once.

    Rows of `width` values are scanned from both ends: a window is the end of one row and the start of the next.
    """
    n = len(values)
    rows = -(-n // width)
    square = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    square[:n] = values
    square = square.reshape(rows, width)
    place = np.arange(rows * width, dtype=np.int64).reshape(rows, width)
    upto = np.minimum.accumulate(square, axis=1)
    fresh = np.ones((rows, width), bool)
    fresh[:, 1:] = square[:, 1:] < upto[:, :-1]
    upto_at = np.maximum.accumulate(np.where(fresh, place, 0), axis=1)
    back = square[:, ::-1]
    onward = np.minimum.accumulate(back, axis=1)
    fresh[:, 1:] = back[:, 1:] <= onward[:, :-1]
    onward_at = np.minimum.accumulate(np.where(fresh, place[:, ::-1], rows * width), axis=1)[:, ::-1]
    windows = n - width + 1
    first, last = slice(0, windows), slice(width - 1, width - 1 + windows)
    onward, upto = onward[:, ::-1].reshape(-1)[first], upto.reshape(-1)[last]
    at = np.where(onward <= upto, onward_at.reshape(-1)[first], upto_at.reshape(-1)[last])
    # Places never decrease from window to window.
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, Rolling | None]:
    """Places and hashes of a text's anchors."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), None
    rolling = Rolling(data)
    starts = np.arange(len(data) - gram + 1)
    hashes = rolling(starts, starts + gram)
    at = _least(hashes, length - gram + 1)
    return at, hashes[at], rolling


def _bytes(value) -> np.ndarray:
    raw = value.as_buffer()
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def _suffixes(length: int, gram: int, remembered: int = 200_000):
    """gram, tid and whether the text has it twice, of each text once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            grams, tids, twice, held = [], [], [], 0
            for tid, text in zip(batch.column("tid").to_pylist(), batch.column("text"), strict=True):
                if tid in seen:
                    continue
                if len(seen) >= remembered:
                    seen.clear()
                seen.add(tid)
                _, found, _ = anchors(_bytes(text), length, gram)
                distinct, counts = np.unique(found, return_counts=True)
                grams.append(distinct)
                tids.append(np.full(len(distinct), tid, np.int64))
                twice.append(counts > 1)
                held += len(distinct)
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(tids)), pa.array(np.concatenate(twice))],
                    ["gram", "tid", "twice"],
                )

    return run


class SuffixFamily:
    """Levels of suffix arrays, each over twice as many batches as the one below, and the anchors found to repeat."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []
        self.repeats: list[DataFrame] = []

    def add(self, suffixes: DataFrame) -> None:
        """Take in a batch (gram, tid, twice): scan it against the family, then merge equal sizes."""
        array = self._array(suffixes.dropDuplicates(["gram", "tid"]))
        own = array.groupBy("gram").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).filter("n > 1 OR twice")
        found = own.select("gram")
        for _, level in self.levels:
            found = found.union(array.select("gram").join(level.select("gram"), "gram", "left_semi"))
        self.repeats.append(saved(found.distinct()))
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, level = self.levels.pop()
            array, size = self._array(array.union(level).dropDuplicates(["gram", "tid"])), size * 2
        self.levels.append((size, array))

    @staticmethod
    def _array(rows: DataFrame) -> DataFrame:
        return saved(rows.repartitionByRange("gram", "tid").sortWithinPartitions("gram", "tid"))

    def repeated(self) -> DataFrame:
        """gram and tid of every suffix whose anchor occurs twice."""
        grams = self.repeats[0]
        for more in self.repeats[1:]:
            grams = grams.union(more)
        grams = grams.distinct()
        entries = self.levels[0][1]
        for _, level in self.levels[1:]:
            entries = entries.union(level)
        return entries.join(grams, "gram", "left_semi").select("gram", "tid")


def _surroundings(length: int, gram: int):
    """Around each repeated anchor: the bytes before and after it. Equal surroundings within a text are one row `twice`."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, text, grams in zip(
                batch.column("tid").to_pylist(), batch.column("text"), batch.column("grams"), strict=True
            ):
                data = _bytes(text)
                at, hashes, rolling = anchors(data, length, gram)
                wanted = np.array(grams.as_py(), np.int64).view(np.uint64)
                hit = np.isin(hashes, wanted)
                at, hashes = at[hit], hashes[hit]
                if not len(at):
                    continue
                first, stop = np.maximum(at - reach, 0), np.minimum(at + length, len(data))
                whole = rolling(first, stop) ^ mixed((at - first).astype(np.uint64))
                _, one, which, many = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
                raw = data.tobytes()
                for begin in range(0, len(one), 5000):
                    some = one[begin : begin + 5000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes[some].view(np.int64)), pa.array(np.full(len(some), tid, np.int64)),
                            pa.array([at[which == which[i]].tolist() if many[which[i]] > 1 else [int(at[i])] for i in some], pa.list_(pa.int64())),
                            pa.array([raw[first[i] : at[i]] for i in some], pa.binary()),
                            pa.array([raw[at[i] : stop[i]] for i in some], pa.binary()),
                        ],
                        ["gram", "tid", "places", "before", "after"],
                    )

    return run


_SURROUNDINGS = "gram long, tid long, places array<long>, before binary, after binary"
_SPANS = "tid long, start long, stop long"


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _padded(parts: list[bytes], width: int, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts])
    out = np.zeros((len(parts), width), np.uint8)
    for row, part in zip(out, parts, strict=True):
        data = np.frombuffer(part, np.uint8)
        row[: len(data)] = data[::-1] if backwards else data
    return out, lengths


def _agreement(rows: np.ndarray, lengths: np.ndarray, one, two) -> np.ndarray:
    """Leading bytes on which rows agree, no more than either has."""
    differ = rows[one] != rows[two]
    found = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.minimum(found, np.minimum(lengths[one], lengths[two]))


def repeated_offsets(before: list[bytes], after: list[bytes], twice: np.ndarray, length: int, gram: int) -> list[list[tuple[int, int]]]:
    """For each of a few anchors with one hash: ranges of o such that the string that starts o bytes before is repeated.

    Suffixes are put in order on both sides; those that agree on the first bytes stand together, so for each o one pass over
    both orders gives the groups that agree on o bytes before and length - o after.
    """
    reach, n = length - gram, len(after)
    left, left_len = _padded(before, reach, True)
    right, right_len = _padded(after, length, False)

    def order(rows, lengths):
        # Equal contents have one rank, so that of those the shorter come first: they differ in NUL bytes at the end.
        _, rank = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_inverse=True)
        place = np.lexsort((lengths, rank.ravel()))
        return place, _agreement(rows, lengths, place[:-1], place[1:])

    if n == 1:
        can = np.arange(reach + 1)
        return [_runs((can <= left_len[0]) & (length - can <= right_len[0]) & twice[0])]
    if n == 2 and not twice.any():
        a = int(_agreement(left, left_len, [0], [1])[0])
        b = int(_agreement(right, right_len, [0], [1])[0])
        found = [(max(0, length - b), a)] if length - b <= a else []
        return [found, found]
    by_left, agree_left = order(left, left_len)
    by_right, agree_right = order(right, right_len)
    flags = np.zeros((n, reach + 1), bool)
    group_left, group_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # Groups change only where an agreement or a text ends.
    turns = np.concatenate(([0], agree_left + 1, left_len + 1, length - agree_right, length - right_len))
    turns = np.unique(turns[(turns >= 0) & (turns <= reach)])
    for o, onward in zip(turns.tolist(), [*turns[1:].tolist(), reach + 1], strict=True):
        fits = (left_len >= o) & (right_len >= length - o)
        if not fits.any():
            continue
        group_left[by_left] = np.concatenate(([0], np.cumsum(agree_left < o)))
        group_right[by_right] = np.concatenate(([0], np.cumsum(agree_right < length - o)))
        _, which = np.unique(group_left * n + group_right, return_inverse=True)
        total = np.bincount(which[fits], weights=1 + twice[fits], minlength=which.max() + 1)
        flags[:, o:onward] = (fits & (total[which] > 1))[:, None]
    return [_runs(f) for f in flags]


def _compared(length: int, gram: int):
    """Spans of repeated strings around the anchors of whole groups; rows arrive in the order of gram."""

    def spans(rows: list[tuple]) -> list[tuple[int, int, int]]:
        # Equal surroundings are compared once; a text that two tasks have read comes twice.
        places: dict[tuple[bytes, bytes], set[tuple[int, int]]] = {}
        for _, tid, at, before, after in rows:
            places.setdefault((before, after), set()).update((tid, x) for x in at)
        twice = np.array([len(x) > 1 for x in places.values()])
        found = repeated_offsets([k[0] for k in places], [k[1] for k in places], twice, length, gram)
        return [
            (tid, at - last, at - first + length)
            for members, ranges in zip(places.values(), found, strict=True) for first, last in ranges for tid, at in members
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple[int, int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if group and group[0][0] != row[0]:
                    out += spans(group)
                    group = []
                group.append(row)
            if out:
                yield _spans_batch(out)
                out = []
        if group:
            out += spans(group)
        if out:
            yield _spans_batch(out)

    return run


def _spans_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["tid", "start", "stop"])


def _divided(length: int):
    """Around a hot anchor, hashes of what the strings that start lo..hi bytes before have in common, and of all they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner, outer = [], []
            for before, after, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("before", "after", "lo", "hi")), strict=True):
                whole, at = before + after, len(before)
                inner.append(hashlib.md5(whole[at - lo : at + length - hi]).digest() if lo <= at and length - hi <= len(after) else None)
                outer.append(hashlib.md5(whole[at - hi : at + length - lo]).digest() if hi <= at and length - lo <= len(after) else None)
            yield batch.append_column("inner", pa.array(inner, pa.binary())).append_column("outer", pa.array(outer, pa.binary()))

    return run


_HOT = ("gram", "tid", "places", "before", "after")


def _hot_spans(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans around anchors that occur very often, by counting hashes; no task sees all rows of an anchor."""
    spark, reach = rows.sparkSession, length - gram
    spans = spark.createDataFrame([], _SPANS)
    # Rows that are `given` have their spans; one of each kind stays as a partner of the others.
    active = rows.dropDuplicates(["tid", "places"]).selectExpr(*_HOT, "0 AS lo", f"{reach} AS hi", "false AS given")
    keys = ["gram", "lo", "hi"]
    step = f"cast(ceil((hi - lo + 1) / {PARTS}D) AS int)"
    parts = f"inline(transform(sequence(lo, hi, {step}), x -> struct(x AS lo, cast(least(hi, x + {step} - 1) AS int) AS hi)))"
    weight = F.sum(F.when(F.col("given"), 2).otherwise(F.least(F.size("places"), F.lit(2))))
    while True:
        divided = active.selectExpr(*_HOT, "given", parts)
        schema = divided.schema.simpleString()[len("struct<") : -1] + ",inner:binary,outer:binary"
        hashed = saved(divided.mapInArrow(_divided(length), schema).filter("inner IS NOT NULL"))
        repeated = {
            side: hashed.filter(F.col(side).isNotNull()).groupBy(*keys, side).agg(weight.alias("n")).filter("n > 1").drop("n")
            for side in ("inner", "outer")
        }
        full = hashed.filter("NOT given").join(repeated["outer"], [*keys, "outer"], "left_semi")
        spans = spans.union(full.select("tid", F.explode("places").alias("at"), "lo", "hi").selectExpr("tid", "at - hi", f"at - lo + {length}"))
        some = hashed.filter("NOT given AND lo < hi").join(repeated["inner"], [*keys, "inner"], "left_semi")
        rest = saved(some.join(repeated["outer"], [*keys, "outer"], "left_anti"))
        if not rest.limit(1).count():
            return spans
        partners = hashed.filter("given").select(full.columns).union(full).dropDuplicates([*keys, "outer"])
        partners = partners.join(rest.select(*keys, "inner").distinct(), [*keys, "inner"], "left_semi").withColumn("given", F.lit(True))
        columns = [*_HOT, "lo", "hi", "given"]
        active = rest.select(columns).union(partners.select(columns))


def repeated_spans(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, hot_from: int = HOT
) -> DataFrame:
    """tid, start and stop of spans covered by repeated strings, of texts (tid, text); spans may overlap."""
    spark = texts.sparkSession
    found = saved(texts.mapInArrow(_suffixes(length, gram), "gram long, tid long, twice boolean"))
    family = SuffixFamily(spark)
    for number in range(batches):
        family.add(found.filter(F.pmod(F.xxhash64("tid"), F.lit(batches)) == number))
    repeated = saved(family.repeated())
    wanted = saved(repeated.groupBy("tid").agg(F.collect_list("gram").alias("grams")))
    bits = id_bits(wanted, "tid")
    likely = placed(texts, bits, "tid").mapInArrow(passing(spark.sparkContext.broadcast(bits), "tid"), "tid long, text string")
    around = saved(likely.join(wanted, "tid").mapInArrow(_surroundings(length, gram), _SURROUNDINGS))
    hot = saved(around.groupBy("gram").count().filter(f"count > {hot_from}").select("gram"))
    usual = around.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    spans = usual.select("gram", "tid", "places", "before", "after").mapInArrow(_compared(length, gram), _SPANS)
    if hot.limit(1).count():
        spans = spans.union(_hot_spans(around.join(hot, "gram"), length, gram))
    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add spans (joined, maximal) and kept (the other bytes)."""
    for batch in batches:
        kept, spans = [], []
        for text, starts, stops in zip(batch.column("text"), batch.column("starts").to_pylist(), batch.column("stops").to_pylist(), strict=True):
            raw = _bytes(text).tobytes()
            joined: list[list[int]] = []
            for start, stop in sorted(zip(starts or [], stops or [], strict=True)):
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], stop)
                else:
                    joined.append([start, stop])
            edges = [0, *(x for s in joined for x in s), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "stop": b} for a, b in joined])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(_bytes(x)) for x in batch.column("text")], pa.int64()),
             pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, hot_from: int = HOT
) -> DataFrame:
    """doc_id, n_bytes, spans (removed, maximal) and kept (the remaining bytes) of every document."""
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("tid", F.xxhash64("text"))
    spans = repeated_spans(texts.select("tid", "text"), length, gram, batches, hot_from)
    copies = texts.filter(F.octet_length("text") >= length).groupBy("tid").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("stop"))
    whole = copies.filter("n > 1").select("tid", F.lit(0).cast("long").alias("start"), F.col("stop").cast("long"))
    cuts = spans.union(whole).groupBy("tid").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("s")
    ).select("tid", "s.start", "s.stop").toDF("tid", "starts", "stops")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.join(saved(cuts), "tid", "left").select("doc_id", "text", "starts", "stops").mapInArrow(
        _cut, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )


def query(spark, folder):
    done = without_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.stop - s.start)
    return done.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
