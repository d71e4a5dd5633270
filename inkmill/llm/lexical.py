"""Ranked lexical search with bit-sliced Bloom signatures.

The index holds, for each part of the documents, one Bloom signature per document, turned by 90 degrees: row i of a signature
block has bit i of all its documents, so the AND of a term's few rows is a bitmap of the documents that may hold it. Documents
of a part are put into blocks by the number of their keys, so that a signature is as wide as its documents need. A term that
occurs 2, 4, 8, ... times is entered once more for each such level; the levels found bound its count from above. The same pass
writes the document frequencies and lengths.

A search bounds every document's score from above by the weighted sums of the slices found, in whole numbers, so that the bound
of a document without false hits and repeats is its score. The best bounds of each item are scored exactly in the documents'
texts; the last of these scores, with its id, is the floor of the item. Every document whose bound does not lie below the floor
is then scored exactly. Nothing else can be among the best, whatever the signatures look like.

Items are searched in blocks of bounded size against all signatures. Texts of candidates are found through a bitmap of bounded
size, without shuffling other texts.

Defined results: a null or empty text, or one without terms, has no score; rows of documents are documents of their own, also
if they share an id; rows that share an item_id, or have none, are one item with the terms of all; ties go by doc_id, nulls
last; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.llm import lookup, wordstream
from inkmill.llm.common import saved, table, whole_text

#: Bits of a signature for each key (as many again at most, since widths are powers of two times this), rows of a key.
KEY_BITS, KEY_ROWS = 10, 4
#: Items, and terms of all items, that are searched together; terms whose bitmaps are summed at once.
BLOCK_ITEMS, BLOCK_TERMS, SUMMED = 256, 1 << 18, 4096

#: Byte classes: 0 belongs to a term.
KINDS = np.array([0 if c > 0x7F or chr(c).isalnum() else 1 for c in range(256)], np.uint8)
_TRANSLATED = bytes(32 if KINDS[c] else int(wordstream.LOWER[c]) for c in range(256))

_PARTS = [T.StructField("width", T.LongType()), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType())]
_TERMS = [T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("found", T.ArrayType(T.LongType()))]


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TRANSLATED).split()


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """A hash for each term and level."""
    x = hashes + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The signature's rows of each term at a level."""
    x = _mixed(hashes, level)
    low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([((low + np.uint64(i) * high) % np.uint64(width)).astype(np.int64) for i in range(KEY_ROWS)], axis=1)


def _hashes(terms) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))


def _signatures(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray, int, bytes]], list[bytes], np.ndarray]:
    """Blocks (documents, sizes, width, bits) of some texts; their terms, and in how many documents each is."""
    numbers, dictionary, text_of, _, _ = wordstream.words(texts, KINDS)
    terms = dictionary.to_pylist()
    pairs, counts = np.unique(text_of * len(terms) + numbers, return_counts=True) if len(terms) else (numbers, numbers)
    if not len(pairs):
        return [], [], np.zeros(0, np.int64)
    docs, held = pairs // len(terms), pairs % len(terms)
    sizes = np.bincount(docs, counts, minlength=len(texts)).astype(np.int64)
    hashes, levels = _hashes(terms), np.frexp(counts.astype(np.float64))[1]
    keys = np.bincount(docs, levels, minlength=len(texts)).astype(np.int64)
    group = np.maximum(4, np.ceil(np.log2(np.maximum(keys, 1))).astype(np.int64))
    blocks = []
    for g in np.unique(group[keys > 0]).tolist():
        members = np.flatnonzero((group == g) & (keys > 0))
        column = np.full(len(texts), -1)
        column[members] = np.arange(len(members))
        chosen = column[docs] >= 0
        width, bits = KEY_BITS << g, np.zeros((KEY_BITS << g, len(members)), np.uint8)
        for level in range(int(levels[chosen].max())):
            now = chosen & (levels > level)
            rows = _places(hashes[held[now]], level, width)
            bits[rows, column[docs[now]][:, None]] = 1
        blocks.append((members, sizes[members], width, np.packbits(bits, axis=1).tobytes()))
    return blocks, terms, np.bincount(held, minlength=len(terms))


def index(docs: DataFrame) -> DataFrame:
    """Signature blocks (ids, width, sizes, bits) and, in rows of their own, the terms of each part and how many documents hold
    them (terms, found)."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema["doc_id"].dataType)), *_PARTS, *_TERMS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = pa.list_(batch.schema.field("doc_id").type)
            kinds = [form, pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            for part in wordstream.parts(batch):
                blocks, terms, found = _signatures(part.column("text"))
                ids = part.column("doc_id")
                out = [(ids.take(pa.array(m)).to_pylist(), width, sizes, bits, None, None) for m, sizes, width, bits in blocks]
                out.append((None, None, None, None, terms, found))
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term and times (how often it stands in the item)."""
    rows = items.select("item_id", whole_text().alias("text"))
    schema = T.StructType([rows.schema["item_id"], T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = Counter(terms_of(batch.column("text")[i].as_py()))
                ids = pa.array([batch.column("item_id")[i].as_py()] * len(found), batch.schema.field("item_id").type)
                columns = [ids, pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema).groupBy("item_id", "term").agg(F.sum("times").alias("times"))


class Asked:
    """Items of one block: their terms' weights, and the corpus figures that scores need."""

    def __init__(self, weights: list[tuple[int, bytes, int]], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.terms = sorted({t for _, t, _ in weights})
        place = {t: i for i, t in enumerate(self.terms)}
        self.hashes = _hashes(self.terms)
        self.n_items = 1 + max((i for i, _, _ in weights), default=-1)
        self.by_item: list[list[tuple[bytes, int]]] = [[] for _ in range(self.n_items)]
        for i, t, w in weights:
            self.by_item[i].append((t, w))
        self.item, self.term, self.weight = (np.array(x, np.int64) for x in ([i for i, _, _ in weights], [place[t] for _, t, _ in weights], [w for _, _, w in weights]))
        #: Sums of doubles are exact below 2**53; beyond that bounds are raised by more than they can be off.
        most = max((1_000_000 * sum(w for _, w in x) for x in self.by_item), default=0)
        self.slack = 0.0 if most < 2**53 else 1e-9

    def lengths(self, sizes) -> list[int]:
        """The length figure m of documents of these sizes."""
        return [75 + 25 * n * self.n_docs // self.n_terms for n in sizes]

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(w * (1_000_000_000 * tf // (1000 * tf + 12 * m)) for t, w in self.by_item[item] if (tf := counts.get(t)))

    def bounds(self, sizes: np.ndarray, width: int, bits: bytes) -> np.ndarray:
        """Upper bounds of the scores of a block's documents (rows) for all items (columns)."""
        n, across = len(sizes), -(-len(sizes) // 8)
        rows = np.frombuffer(bits, np.uint8).reshape(width, across)
        m = np.array(self.lengths(sizes.tolist()), np.float64)
        total = np.zeros((n, self.n_items))
        for start in range(0, len(self.terms), SUMMED):
            own = np.arange(start, min(len(self.terms), start + SUMMED))
            held = np.zeros((len(own), n), np.int64)
            live, level = np.arange(len(own)), 0
            before = np.full((len(own), across), 255, np.uint8)
            while len(live):
                found = np.bitwise_and.reduce(rows[_places(self.hashes[own[live]], level, width)], axis=1) & before
                some = found.any(axis=1)
                live, before = live[some], found[some]
                held[live] += np.unpackbits(before, axis=1, count=n)
                level += 1
            used = np.flatnonzero(held.any(axis=1))
            # A term at k levels occurs 2**k - 1 times at most, and no oftener than the document has terms.
            most = np.minimum(np.exp2(held[used]) - 1, sizes[None, :])
            impact = np.floor(1e9 * most / (1000 * most + 12 * m[None, :])) + (most > 0)
            table = np.zeros((len(used), self.n_items))
            seat = np.full(len(self.terms), -1)
            seat[own[used]] = np.arange(len(used))
            here = seat[self.term] >= 0
            np.add.at(table, (seat[self.term[here]], self.item[here]), self.weight[here])
            total += impact.T @ table
        return total * (1 + self.slack)


def _first(scored: DataFrame, by: str, k: int) -> DataFrame:
    """The k best rows of each item."""
    order = Window.partitionBy("item").orderBy(F.desc(by), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _bounded(signatures: DataFrame, asked, k: int, floors=None) -> DataFrame:
    """item, doc_id and bound: the k best bounds of each task, or with floors every bound that reaches its item's floor."""
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("doc_id", signatures.schema["ids"].dataType.elementType),
        T.StructField("bound", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, form = asked.value, None
        # The best of the task so far: bounds, and the ids as a list of arrays put together now and then.
        best: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def batch_of(item, bound, ids) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(bound, pa.float64())], names=schema.names)

        def shortened() -> None:
            item, bound = (np.concatenate([b[i] for b in best]) for i in (0, 1))
            ids = pa.concat_arrays([b[2] for b in best])
            rank = np.asarray(pc.array_sort_indices(ids, null_placement="at_end"))
            order_of = np.empty(len(rank), np.int64)
            order_of[rank] = np.arange(len(rank))
            order = np.lexsort((order_of, -bound, item))
            sorted_items = item[order]
            begins = np.searchsorted(sorted_items, sorted_items, side="left")
            kept = order[np.arange(len(order)) - begins < k]
            best[:] = [(item[kept], bound[kept], ids.take(pa.array(kept)))]

        for batch in batches:
            form = batch.schema.field("ids").type.value_type
            for width, sizes, bits, ids in zip(
                *(batch.column(c).to_pylist() for c in ("width", "sizes", "bits")), batch.column("ids"), strict=True
            ):
                ids = pa.array(ids.values, form)
                for_items = a.bounds(np.array(sizes, np.int64), width, bits)
                if floors is None:
                    hit = for_items > 0
                    if len(sizes) > k:
                        hit &= for_items >= np.partition(for_items, -k, axis=0)[-k]
                else:
                    hit = (for_items > 0) & (for_items >= floors.value)
                at, item = np.nonzero(hit)
                if len(at):
                    best.append((item, for_items[at, item], ids.take(pa.array(at))))
                if floors is not None and best:
                    yield batch_of(*best.pop())
                elif sum(len(b[0]) for b in best) > 50_000 + 2 * k * a.n_items:
                    shortened()
        if best:
            shortened()
            yield batch_of(*best[0])

    return signatures.mapInArrow(run, schema)


def _scored(docs: DataFrame, wanted: DataFrame, asked) -> DataFrame:
    """item, doc_id and the exact score of every document with a wanted id, one row per document and item."""
    grouped = saved(wanted.groupBy("doc_id").agg(F.collect_set("item").alias("items")))
    bits = docs.sparkSession.sparkContext.broadcast(lookup.id_bits(grouped, "doc_id"))
    rows = lookup.placed(docs.select("doc_id", whole_text().alias("text")), bits.value, "doc_id")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = lookup.chosen(batch, bits.value)
            if part.num_rows:
                yield part.select(["doc_id", "text"])

    found = rows.mapInArrow(near, rows.drop("place").schema).alias("d")
    joined = found.join(grouped.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))).select("d.doc_id", "text", "items")
    schema = T.StructType([T.StructField("item", T.IntegerType()), joined.schema["doc_id"], T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = asked.value
        for batch in batches:
            for part in wordstream.parts(batch):
                at, items, scores = [], [], []
                for i, (text, own) in enumerate(zip(part.column("text").to_pylist(), part.column("items").to_pylist(), strict=True)):
                    terms = terms_of(text)
                    counts, m = Counter(terms), a.lengths([len(terms)])[0]
                    for item in own:
                        score = a.score(item, counts, m)
                        if score > 0:
                            at.append(i)
                            items.append(item)
                            scores.append(score)
                ids = part.column("doc_id").take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), ids, pa.array(scores, pa.int64())], names=schema.names)

    return joined.mapInArrow(run, schema)


def _weighted(terms: DataFrame, signatures: DataFrame, n_docs: int) -> DataFrame:
    """item_id, term and weight: times the term stands in the item by its weight in the corpus; terms in no document are left
    out, and so are those of weight 0."""
    held = signatures.filter("terms IS NOT NULL").selectExpr("inline(arrays_zip(terms, found))").toDF("term", "found")
    asked = terms.select("term").distinct()
    frequency = saved(held.join(asked, "term", "left_semi").groupBy("term").agg(F.sum("found").alias("df")))
    schema = T.StructType([terms.schema["item_id"], T.StructField("term", T.BinaryType()), T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in batch.column("df").to_pylist()]
            weight = [w * times for w, times in zip(of, batch.column("times").to_pylist(), strict=True)]
            columns = [batch.column("item_id"), batch.column("term"), pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array([w > 0 for w in weight], pa.bool_()))

    return terms.join(frequency, "term").select("item_id", "term", "times", "df").mapInArrow(run, schema)


def _blocks(weighted: DataFrame) -> Iterator[tuple[list, list[tuple[int, bytes, int]]]]:
    """Items and weights in blocks that fit one broadcast: at most BLOCK_ITEMS items, and BLOCK_TERMS terms unless one item has more."""
    ids, weights = [], []
    grouped = weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("own"))
    for r in grouped.toLocalIterator():
        if ids and (len(ids) == BLOCK_ITEMS or len(weights) + len(r.own) > BLOCK_TERMS):
            yield ids, weights
            ids, weights = [], []
        weights += [(len(ids), bytes(t.term), t.weight) for t in r.own]
        ids.append(r.item_id)
    if ids:
        yield ids, weights


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item."""
    spark = docs.sparkSession
    context = spark.sparkContext
    built = saved(index(docs))
    signatures = built.filter("ids IS NOT NULL").select("ids", "width", "sizes", "bits")
    figures = built.agg(
        F.sum(F.expr("CASE WHEN ids IS NOT NULL THEN size(ids) END")).alias("n"),
        F.sum(F.expr("aggregate(sizes, cast(0 AS bigint), (a, x) -> a + x)")).alias("l"),
    ).first()
    n_docs, n_terms = figures.n or 0, figures.l or 1
    weighted = saved(_weighted(saved(item_terms(items)), built, n_docs))
    schema = T.StructType([
        weighted.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())
    ])
    results = spark.createDataFrame([], schema)
    for ids, weights in _blocks(weighted):
        asked = context.broadcast(Asked(weights, n_docs, n_terms))
        tried = saved(_first(_bounded(signatures, asked, k), "bound", k).select("item", "doc_id"))
        scored = saved(_scored(docs, tried, asked))
        last = saved(_first(scored, "score", k).filter(F.col("rank") == k).select("item", F.col("doc_id").alias("last"), "score"))
        floors = np.zeros(len(ids))
        for r in last.collect():
            floors[r["item"]] = r.score
        # Every document whose bound reaches the floor, but for those already scored and those after the last at the floor itself.
        reached = _bounded(signatures, asked, k, context.broadcast(floors))
        after = F.coalesce((F.col("bound") == F.col("score")) & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("last"))), F.lit(False))
        after = after & F.col("last").isNotNull()
        rest = reached.join(F.broadcast(last), "item", "left").filter(~after).select("item", "doc_id").alias("r")
        same = (F.col("r.item") == F.col("t.item")) & F.col("r.doc_id").eqNullSafe(F.col("t.doc_id"))
        more = _scored(docs, rest.join(tried.alias("t"), same, "left_anti"), asked)
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), weighted.schema["item_id"]]))
        best = saved(_first(scored.unionByName(more), "score", k))
        results = results.unionByName(best.join(F.broadcast(names), "item").select(*schema.names))
    return results


def query(spark, folder):
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), d AS (
  SELECT doc_id, terms, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0
), c AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d
), p AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL
), f AS (
  SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term
), q AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), w AS (
  SELECT item_id, term, times * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM q JOIN f USING (term), c
), s AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM w JOIN p USING (term), c GROUP BY item_id, doc_id
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
