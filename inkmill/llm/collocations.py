r"""Phrase collocation mining by multikey three-way quicksort of suffix pointers.

A suffix is a word with the words that follow it in its piece, up to the phrase length. Tasks take their texts apart, merge equal
suffixes of a part into one with a count, and pack them into blocks by route: the hash of the two leading words. Routes are so
many that the suffixes of one fit a task; a pair of leading words that holds a good share of all suffixes (found by a first
count, which also gives the words' frequencies) is routed by its third word too. A task then sorts the pointers of one route:
three-way partitioning by the first word, the equal part by the next word, and so on to the greatest depth. The size of an equal
part is the count of its phrase; a part below the least count is abandoned at once. Small parts are finished by one sort. Counts
of a pair that was dealt to several routes are summed afterwards, so such a pair is never abandoned early.

Scores compare a phrase with its parts in exact whole numbers.

Defined results: a null text has no words, a null language is `und`; equal rows count as often as they occur; an empty table gives
no phrases. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.llm import wordstream
from inkmill.llm.common import saved, table, whole_text

#: Words of the longest phrase.
DEPTH = 3
#: Pointers below which a part is finished by one sort.
SMALL = 2048
#: Parts that each language's phrases are ranked in before they meet.
SALTS = 32

#: Byte classes: word, blank, end of a piece.
KINDS = np.zeros(256, np.uint8)
KINDS[list(b" \t")] = 1
KINDS[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _sequences(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers (from 1) of all words in order, 0 between pieces and at the end; the dictionary of numbers 1 and up."""
    numbers, dictionary, text_of, starts, kind = wordstream.words(texts, KINDS)
    if not len(numbers):
        return np.zeros(1, np.int64), dictionary
    piece = np.cumsum(kind == 2)[starts]
    ends = np.flatnonzero((np.diff(piece) != 0) | (np.diff(text_of) != 0)) + 1
    return np.append(np.insert(numbers + 1, ends, 0), 0), dictionary


def _runs(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns, sorted, and the sum of each one's weights."""
    order = np.lexsort(columns[::-1])
    columns, weights = [c[order] for c in columns], weights[order]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(weights, first) if len(first) else weights


def _suffixes(numbers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct suffixes of two words or more (a missing third word is 0), and how often each occurs."""
    padded = np.concatenate([numbers, np.zeros(DEPTH, np.int64)])
    columns = [padded[i : i + len(numbers)] for i in range(DEPTH)]
    here = (columns[0] > 0) & (columns[1] > 0)
    columns = [c[here] for c in columns]
    # A word past the end of the piece is none, whatever stands there.
    for before, column in zip(columns[1:], columns[2:]):
        column[before == 0] = 0
    base = int(numbers.max(initial=0)) + 1
    if base**DEPTH < 2**63:
        key = columns[0]
        for c in columns[1:]:
            key = key * base + c
        key, counts = np.unique(key, return_counts=True)
        return [key // base ** (DEPTH - 1 - i) % base for i in range(DEPTH)], counts
    return _runs(columns, np.ones(len(columns[0]), np.int64))


def _hashes(dictionary: pa.Array) -> np.ndarray:
    """A hash for each word, that of number 0 first."""
    found = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in dictionary.to_pylist()), np.uint64, len(dictionary))
    return np.concatenate([np.zeros(1, np.uint64), found])


def _combined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first ^ (second * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    for part in wordstream.parts(batch, most_rows=1 << 30, most_bytes=4 * wordstream.PART_BYTES):
        lang = part.column("lang")
        for value in pc.unique(lang).to_pylist():
            yield value, part.filter(pc.equal(lang, value)).column("text")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))


def word_counts(docs: DataFrame, share: float) -> DataFrame:
    """lang, word, pair and count of each part: the count of every word, and that of pairs with at least a `share` of the part's
    words. A pair is the hash of its words; its rows have no word."""
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("word", T.BinaryType()), T.StructField("pair", T.LongType()),
        T.StructField("count", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                numbers, dictionary = _sequences(texts)
                counts = np.bincount(numbers, minlength=len(dictionary) + 1)[1:]
                hashes = _hashes(dictionary)
                pairs = _combined(hashes[numbers[:-1]], hashes[numbers[1:]])[(numbers[:-1] > 0) & (numbers[1:] > 0)]
                values, often = np.unique(pairs, return_counts=True)
                large = often >= max(2, share * counts.sum())
                values, often = values[large].view(np.int64), often[large]
                n, m = len(counts), len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (n + m), pa.string()),
                        pa.concat_arrays([dictionary.cast(pa.binary()), pa.nulls(m, pa.binary())]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(values)]),
                        pa.array(np.concatenate([counts, often]), pa.int64()),
                    ],
                    names=schema.names,
                )

    return _texts(docs).mapInArrow(run, schema)


def _packed(dictionary: pa.Array) -> bytes:
    """Words as one text; none holds a line feed."""
    return b"\n".join(dictionary.to_pylist())


def suffix_blocks(docs: DataFrame, routes: int, hot: np.ndarray) -> DataFrame:
    """lang, route, words and suffixes (numbers of words and counts, as compressed arrays) of each part's distinct suffixes."""
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("route", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("words", T.BinaryType()), T.StructField("suffixes", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = pa.Codec("zstd", compression_level=1).compress
        for batch in batches:
            for lang, texts in _by_language(batch):
                numbers, dictionary = _sequences(texts)
                columns, counts = _suffixes(numbers)
                if not len(counts):
                    continue
                hashes = _hashes(dictionary)
                pair = _combined(hashes[columns[0]], hashes[columns[1]])
                full = _combined(pair, hashes[columns[2]])
                place = np.where(np.isin(pair.view(np.int64), hot), full, pair) % np.uint64(routes)
                order = np.argsort(place, kind="stable")
                place = place[order]
                edges = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                out = []
                for start, stop in zip(edges, np.append(edges[1:], len(place)), strict=True):
                    own = order[start:stop]
                    used, numbered = np.unique(np.concatenate([c[own] for c in columns]), return_inverse=True)
                    zero = int(used[0] == 0)
                    numbered = (numbered + 1 - zero).astype("<i4").reshape(DEPTH, -1)
                    # Leading words are in order, so their differences are small.
                    numbered[0] = np.diff(numbered[0], prepend=0)
                    data = np.concatenate([numbered.ravel(), counts[own].astype("<i4")]).view(np.uint8).reshape(-1, 4).T.tobytes()
                    words = _packed(dictionary.take(pa.array(used[zero:] - 1)))
                    out.append((lang, int(place[start]), len(own), bytes(_framed(words, squeeze)), bytes(_framed(data, squeeze))))
                columns_out = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)]
                yield pa.RecordBatch.from_arrays(columns_out, names=schema.names)

    return _texts(docs).mapInArrow(run, schema)


_KINDS = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _framed(data: bytes, squeeze) -> bytes:
    return len(data).to_bytes(8, "little") + bytes(squeeze(data))


def _opened(data: bytes) -> bytes:
    return bytes(pa.Codec("zstd").decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little")))


def quicksorted(columns: list[np.ndarray], counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of two words or more (rows of word numbers, 0 behind the last) and their counts.

    Multikey three-way quicksort of the pointers to the suffixes. Parts with a count below `least` are abandoned.
    """
    depth = len(columns)
    stack = [(np.arange(len(counts)), 0)]
    while stack:
        pointers, at = stack.pop()
        if int(counts[pointers].sum()) < least:
            continue
        if len(pointers) <= SMALL:
            yield from _finished([c[pointers] for c in columns], counts[pointers], at, least)
            continue
        keys = columns[at][pointers]
        middle = np.sort(keys[[0, len(keys) // 2, -1]])[1]
        stack.append((pointers[keys < middle], at))
        stack.append((pointers[keys > middle], at))
        equal = pointers[keys == middle]
        size = int(counts[equal].sum())
        if middle == 0 or size < least:  # 0: the piece ends here
            continue
        if at:
            phrase = [int(c[equal[0]]) for c in columns[: at + 1]] + [0] * (depth - at - 1)
            yield np.array([phrase]), np.array([size])
        if at + 1 < depth:
            stack.append((equal, at + 1))


def _finished(columns: list[np.ndarray], counts: np.ndarray, at: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for a small part, whose first `at` words agree."""
    for depth in range(max(2, at + 1), len(columns) + 1):
        kept = columns[depth - 1] > 0
        found, sizes = _runs([c[kept] for c in columns[:depth]], counts[kept])
        often = sizes >= least
        if often.any():
            rows = np.zeros((int(often.sum()), len(columns)), np.int64)
            for i, c in enumerate(found):
                rows[:, i] = c[often]
            yield rows, sizes[often]


def _partial_pairs(columns: list[np.ndarray], counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hot pairs, dealt by their third word: their longer phrases are complete, their own counts are parts of sums."""
    yield from (x for x in quicksorted(columns, counts, least) if x[0][0, -1])
    found, sizes = _runs(columns[:2], counts)
    yield np.stack([*found, *[np.zeros(len(sizes), np.int64)] * (len(columns) - 2)], axis=1), sizes


def phrase_counts(blocks: DataFrame, routes: int, least: int, hot: np.ndarray) -> DataFrame:
    """lang, w1, w2, w3 (null in pairs) and count; the counts of hot pairs still come in several rows."""
    schema = T.StructType([
        T.StructField("lang", T.StringType()), *(T.StructField(f"w{i}", T.BinaryType()) for i in (1, 2, 3)),
        T.StructField("count", T.LongType()),
    ])

    def counted(lang: str, held: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        dictionaries, columns, counts = [], [], []
        for n, words, suffixes in held:
            data = np.frombuffer(_opened(suffixes), np.uint8).reshape(4, -1).T.copy().view("<i4").reshape(DEPTH + 1, n).astype(np.int64)
            data[0] = np.cumsum(data[0])
            dictionaries.append(pa.array(_opened(words).split(b"\n"), pa.large_binary()))
            columns.append(data[:DEPTH])
            counts.append(data[DEPTH])
        coded = pa.chunked_array(dictionaries).combine_chunks().dictionary_encode()
        number, start = np.asarray(coded.indices, dtype=np.int64) + 1, 0
        for own, data in zip(dictionaries, columns, strict=True):
            data[:] = np.concatenate([np.zeros(1, np.int64), number[start : start + len(own)]])[data]
            start += len(own)
        words = coded.dictionary
        hashes = _hashes(words)
        columns, counts = [np.concatenate([c[i] for c in columns]) for i in range(DEPTH)], np.concatenate(counts)
        split = np.isin(_combined(hashes[columns[0]], hashes[columns[1]]).view(np.int64), hot)
        found = [
            *quicksorted([c[~split] for c in columns], counts[~split], least),
            *_partial_pairs([c[split] for c in columns], counts[split], least),
        ]
        rows, sizes = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        take = lambda c: words.take(pa.array(c - 1, pa.int64(), mask=c == 0)).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(rows), pa.string()), *(take(rows[:, i]) for i in range(DEPTH)), pa.array(sizes, pa.int64())],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for lang, route, *block in zip(*(batch.column(c).to_pylist() for c in ("lang", "route", "n", "words", "suffixes")), strict=True):
                if held and (route, lang) != current:
                    yield from counted(current[1], held)
                    held = []
                current = (route, lang)
                held.append(tuple(block))
        if held:
            yield from counted(current[1], held)

    dealt = blocks.repartition(routes, "route").sortWithinPartitions("route", "lang")
    return dealt.mapInArrow(run, schema)


def _score(a: str, left: str, right: str) -> str:
    """floor(1,000,000 a a / (left right)), with decimals of 38 digits in between."""
    wide = lambda c: f"cast({c} AS decimal(19,0))"
    return f"cast(1000000BD * ({wide(a)} * {wide(a)}) AS decimal(38,0)) div cast({wide(left)} * {wide(right)} AS decimal(38,0))"


def counted_phrases(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: lang and n; lang, word and f; lang, w1, w2, w3 (null in pairs) and a. Words and phrases found `least` times or
    more."""
    spark = docs.sparkSession
    routes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A pair is hot with the share of an average route; parts report it from a quarter of that, so the reports hold at least
    # three quarters of a hot pair, and there are at most 4 / 3 routes such pairs.
    counts = saved(word_counts(docs, 0.25 / routes))
    each = counts.filter("word IS NOT NULL")
    totals = saved(each.groupBy("lang").agg(F.sum("count").alias("n")))
    words = saved(each.groupBy("lang", "word").agg(F.sum("count").alias("f")).filter(F.col("f") >= least))
    everything = totals.agg(F.sum("n").alias("n")).first().n or 0
    pairs = counts.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("count").alias("a"))
    hot = np.array([r.pair for r in pairs.filter(F.col("a") >= 0.75 / routes * everything).collect()], np.int64)
    partial = phrase_counts(suffix_blocks(docs, routes, hot), routes, least, hot)
    phrases = partial.groupBy("lang", "w1", "w2", "w3").agg(F.sum("count").alias("a")).filter(F.col("a") >= least)
    return totals, words, saved(phrases)


def collocations(docs: DataFrame, least: int = 10, most: int = 2000, share: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `most` best phrases of each language.

    A phrase is dropped if a longer one that contains it has at least `share` percent of its count.
    """
    totals, words, phrases = counted_phrases(docs, least)
    pairs = phrases.filter("w3 IS NULL").select("lang", "w1", "w2", "a")
    triples = phrases.filter("w3 IS NOT NULL")
    single = lambda w, f: words.select("lang", F.col("word").alias(w), F.col("f").alias(f))
    double = lambda v, w, f: pairs.select("lang", F.col("w1").alias(v), F.col("w2").alias(w), F.col("a").alias(f))

    covered = F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
    inside = triples.select("lang", "a", covered.alias("p")).groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    free = pairs.join(inside, ["lang", "w1", "w2"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {int(share)} * a"))
    two = free.join(single("w1", "l"), ["lang", "w1"]).join(single("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", *(F.col(c).cast("string") for c in ("w1", "w2"))).alias("phrase"), "a", "l", "r",
                     F.expr(_score("a", "l", "r")).alias("score"))

    three = (
        triples.join(single("w1", "l1"), ["lang", "w1"]).join(double("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(double("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(single("w3", "r2"), ["lang", "w3"])
    )
    three = three.withColumns({"s1": F.expr(_score("a", "l1", "r1")), "s2": F.expr(_score("a", "l2", "r2"))})
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", *(F.col(c).cast("string") for c in ("w1", "w2", "w3"))).alias("phrase"), "a",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    def best(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy("lang", *by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    every = two.unionByName(three).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    ranked = best(best(every, "salt").drop("salt"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, folder):
    return collocations(table(spark, folder, "documents"))


ORACLE = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), t AS (
  SELECT lang, unnest(w) AS w1, unnest(list_concat(w[2 :], [NULL])) AS w2, unnest(list_concat(w[3 :], CASE WHEN len(w) > 1 THEN [NULL, NULL] ELSE [NULL] END)) AS w3 FROM p WHERE len(w) > 0
), f1 AS MATERIALIZED (
  SELECT lang, w1 AS w, count(*)::HUGEINT AS f FROM t GROUP BY ALL
), f2 AS MATERIALIZED (
  SELECT lang, w1, w2, count(*)::HUGEINT AS a FROM t WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), f3 AS MATERIALIZED (
  SELECT lang, w1, w2, w3, count(*)::HUGEINT AS a FROM t WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), longer AS (
  SELECT lang, v, w, max(a) AS longest FROM (SELECT lang, w1 AS v, w2 AS w, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL
), two AS (
  SELECT f2.lang, w1 || ' ' || w2 AS phrase, a, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w = w1 JOIN f1 y ON y.lang = f2.lang AND y.w = w2
  LEFT JOIN longer g ON g.lang = f2.lang AND g.v = w1 AND g.w = w2 WHERE longest IS NULL OR 100 * longest < 50 * a
), cuts AS (
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.a, x.f AS l, y.a AS r, 1 AS k
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, x.a, y.f, 2
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w = f3.w3
), three AS (
  SELECT lang, phrase, a, l, r, score FROM (SELECT *, 1000000 * a * a // (l * r) AS score FROM cuts)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank
  FROM (SELECT * FROM two UNION ALL SELECT * FROM three)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
