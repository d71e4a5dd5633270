"""N-gram Jaccard join: documents whose sets of word shingles overlap by a share of their union, exactly.

Documents with the same set form one class, and a class takes part once. The join of the classes is size-aware:

* Light classes have small sets. They enumerate the pairs (subsets of two) of their first shingles in a global order; two
  classes that reach the threshold have two shingles in common there, so they meet at a pair.
* Heavy classes have large sets, for which subsets would be too many. Their first shingles go to inverted lists, which are
  scanned. Light classes large enough to match a heavy one go there too.

The size that divides them is the one with the least cost over the histogram of set sizes. The global order is rarest first,
by a frequency sketch of fixed size over all documents, so that passages which very many documents share come last and hardly
ever meet. It only decides which shingles are first: results never depend on the sketch.

Classes that meet are links if the sizes of their sets, and the places of the shared shingle, allow it and the sets, compared
in full, reach the threshold. Before sets are compared, their signatures are: one bit per cell of a hash table, which says
whether the cell holds an odd number of shingles. Every bit that differs needs a shingle that only one set has, so signatures
that differ in more bits than two linked sets may differ in shingles rule the pair out; a signature has a thirtieth of a set.

A group of g classes that all meet must not cost g * g comparisons when a few links connect it: lists are first linked along
an order, each class with the next ones, more of them in each round, and components are formed; at last every remaining pair
of a list that lies in different components is compared, in cells of bounded size, so that no link is lost. A list is done
when all its classes are connected, or when all were among each other's next ones. Only classes in pairs that passed the
filters have their sets fetched.

Shingles and sets are compared by 64-bit hashes of their words; the chance of one wrong link is about the squared number of
shingles in two documents over 2**64.

Defined results: null and empty texts, and texts of white space, have an empty set and are linked with nothing; rows with the
same id and text get the same result, one row each; a null id takes no part and is its own component (null); an empty table
gives an empty result. Other columns are ignored, or kept as they are by `one_of_each`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.common import dropped, packed, saved, whole_text
from inkmill.llm.components import connected
from inkmill.llm.lookup import chosen, id_bits, placed
from inkmill.llm.shingles import fingerprint, mixed, sequences

SIZE = 5
#: The threshold as a fraction.
PART, WHOLE = 3, 4
SKETCH_BITS, SKETCH_PARTS = 20, 64
#: Cost of following an entry of an inverted list, in emitted entries; and the largest set that may be light.
SCAN_COST, LARGEST_LIGHT = 2.0, 64
#: Next classes of its list that a class is compared with, in each round; then come all that are left.
REACH = (1, 8, 32)
#: Classes of a list on one side of a cell when all pairs are compared; largest signature in bits (a power of two).
CELL, LARGEST_SIGNATURE = 512, 1 << 17
#: Classes a task remembers, so that it emits copies once.
REMEMBERED = 200_000


def least_overlap(a, b):
    """Shingles two sets of sizes a and b must share."""
    return -(-PART * (a + b) // (PART + WHOLE))


def prefix(n, shared=1):
    """First shingles of a set of n among which `shared` of the common ones lie, whatever the partner."""
    return np.minimum(n, n - -(-PART * n // WHOLE) + shared)


def signature(distinct: np.ndarray) -> bytes:
    """Parities of the cells of a hash table with two to four cells a shingle (up to the largest size)."""
    cells = min(LARGEST_SIGNATURE, max(64, 1 << int(2 * len(distinct) - 1).bit_length()))
    odd = np.bincount((distinct & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(one: np.ndarray, two: np.ndarray) -> int:
    """Cells in which two signatures (64-bit words) differ; the larger table is folded to the size of the other."""
    while len(one) != len(two):
        one, two = (one, two) if len(one) > len(two) else (two, one)
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures differ in no more cells than linked sets of their sizes may differ in shingles."""
    for batch in batches:
        n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
        most = n + m - 2 * least_overlap(n, m)
        sides = zip(batch.column("x"), batch.column("y"), strict=True)
        apart = [differing(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair)) for pair in sides]
        hit = pa.array(np.array(apart, np.int64) <= most)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(hit), batch.column("b").filter(hit)], ["a", "b"])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set size, fingerprint and signature; per task the parts of its frequency sketch."""
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    empty = pa.binary()
    for batch in batches:
        n, prints, signs = [], [], []
        for _, found, _ in sequences(batch.column("text"), SIZE):
            distinct = np.unique(found)
            signs.append(signature(distinct) if len(distinct) > 1 else None)
            np.add.at(counts, (distinct & mask).astype(np.int64), 1)
            n.append(len(distinct))
            prints.append(fingerprint(distinct))
        rows = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(prints, pa.int64()), pa.array(signs, empty),
                pa.nulls(rows, pa.int32()), pa.nulls(rows, empty),
            ],
            ["doc_id", "n", "fp", "sign", "part", "counts"],
        )
    parts = [p.tobytes() for p in np.split(counts, SKETCH_PARTS)]
    k = len(parts)
    yield pa.RecordBatch.from_arrays(
        [*[pa.nulls(k, pa.int64())] * 3, pa.nulls(k, empty), pa.array(range(k), pa.int32()), pa.array(parts, empty)],
        ["doc_id", "n", "fp", "sign", "part", "counts"],
    )


def _summed(key, rows):
    import pandas as pd

    total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint64)
    for part in rows["counts"]:
        total += np.frombuffer(part, np.uint32)
    return pd.DataFrame([{"part": key[0], "counts": np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()}])


def _sketch(profile: DataFrame) -> np.ndarray:
    """Frequency class (four to a doubling) of each sketch cell; always 2**SKETCH_BITS bytes."""
    parts = profile.filter("part IS NOT NULL").select("part", "counts", F.pmod(F.xxhash64("counts"), F.lit(32)).alias("salt"))
    some = parts.groupBy("part", "salt").applyInPandas(_summed, "part int, counts binary")
    rows = some.groupBy("part").applyInPandas(_summed, "part int, counts binary").collect()
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    for r in rows:
        counts[r.part] = np.frombuffer(r.counts, np.uint32)
    return np.round(4 * np.log2(counts.reshape(-1).astype(np.float64) + 1)).astype(np.uint8)


def boundary(sizes: list[tuple[int, int]]) -> int:
    """Sets of fewer shingles are light: the size with the least cost over (size, classes) pairs."""
    n, many = (np.array(x, np.int64) for x in zip(*sizes, strict=True)) if sizes else (np.zeros(0, np.int64),) * 2

    def cost(limit: int) -> float:
        light, listed = n < limit, n >= -(-PART * limit // WHOLE)
        subsets = prefix(n, 2) * (prefix(n, 2) - 1) / 2
        return (many * (light * subsets + listed * prefix(n) * (1 + SCAN_COST))).sum()

    return min(range(2, LARGEST_LIGHT + 1), key=cost)


def _entries(sketch, limit: int):
    listed_from = -(-PART * limit // WHOLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, mask = sketch.value, np.uint64((1 << SKETCH_BITS) - 1)
        seen: set[int] = set()
        for batch in batches:
            out, held = [], 0
            for _, found, _ in sequences(batch.column("text"), SIZE):
                distinct = np.unique(found)
                n = len(distinct)
                if n < 2 or (fp := fingerprint(distinct)) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(fp)
                rank = (classes[(distinct & mask).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (distinct >> np.uint64(8))
                first = distinct[np.argsort(rank, kind="stable")[: prefix(n, 2)]]
                if n >= listed_from:
                    k = int(prefix(n))
                    out.append((first[:k], np.arange(k), fp, n))
                if n < limit:
                    i, j = np.triu_indices(len(first), 1)
                    out.append((mixed(first[i] * np.uint64(3) + mixed(first[j])), np.zeros(len(i), np.int64), fp, n))
                held += len(first)
                if held > 500_000:
                    yield _table(out)
                    out, held = [], 0
            if out:
                yield _table(out)

    return run


def _table(out) -> pa.RecordBatch:
    lengths = [len(o[0]) for o in out]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([o[0] for o in out]).view(np.int64)),
            pa.array(np.repeat(np.array([o[2] for o in out], np.int64), lengths)),
            pa.array(np.repeat(np.array([o[3] for o in out], np.int32), lengths)),
            pa.array(np.concatenate([o[1] for o in out]).astype(np.int32)),
        ],
        ["key", "fp", "n", "at"],
    )


def _shared(entries: DataFrame) -> DataFrame:
    """The entries of keys that at least two classes hold, each class once."""
    order = Window.partitionBy("key").orderBy("fp")
    once = entries.withColumn("before", F.lag("fp").over(order)).filter("before IS NULL OR before != fp")
    both = once.withColumn("before", F.lag("fp").over(order)).withColumn("after", F.lead("fp").over(order))
    return both.filter("before IS NOT NULL OR after IS NOT NULL").select("key", "fp", "n", "at")


#: Whether the sizes of two sets and the places of their first common shingle allow the threshold.
_CAN_LINK = f"""{PART} * greatest(n, m) <= {WHOLE} * least(n, m)
  AND 1 + least(n - at - 1, m - bt - 1) >= ceil({PART} * (n + m) / {PART + WHOLE})
  AND (at <= n - ceil({2 * PART} * n / {PART + WHOLE}) OR bt <= m - ceil({2 * PART} * m / {PART + WHOLE}))"""


def _chained(lists: DataFrame, turn: int) -> DataFrame:
    """Pairs of each class with the next ones along one order of its list, where they lie in different components."""
    order = Window.partitionBy("key").orderBy(F.xxhash64("fp", F.lit(turn)), "fp").rowsBetween(-REACH[turn], -1)
    entry = F.struct(F.col("fp").alias("b"), F.col("n").alias("m"), F.col("at").alias("bt"), F.col("component").alias("other"))
    near = lists.withColumn("near", F.collect_list(entry).over(order))
    test = re.sub(r"\b(m|bt)\b", r"e.\1", _CAN_LINK)
    return near.select(F.col("fp").alias("a"), F.expr(f"explode(filter(near, e -> e.other != component AND {test}).b) AS b"))


def _open(lists: DataFrame, known: DataFrame, reach: int) -> DataFrame:
    """The lists, with components and their number of classes, that may hold links between components which no round has compared.

    After a round, a list of at most reach + 1 classes has been compared in full.
    """
    now = lists.select("key", "fp", "n", "at").join(known.withColumnRenamed("node", "fp"), "fp", "left")
    now = now.withColumn("component", F.coalesce("component", "fp"))
    sums = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("many"))
    return now.join(sums.filter(f"x != y AND many > {reach + 1}").select("key", "many"), "key")


def _crossing(lists: DataFrame) -> DataFrame:
    """All pairs of a list that lie in different components; a long list is dealt to cells of at most CELL classes by all."""
    cells = lists.withColumn("cells", F.expr(f"cast(ceil(many / {CELL}) AS int)"))
    rest = cells.withColumn("cell", F.expr("cast(pmod(xxhash64(fp), cells) AS int)"))
    other = cells.selectExpr("key", "fp AS b", "n AS m", "at AS bt", "component AS other", "explode(sequence(0, cells - 1)) AS cell")
    return rest.join(other, ["key", "cell"]).filter(f"fp < b AND component != other AND {_CAN_LINK}").select(F.col("fp").alias("a"), "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            one, two = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            at = np.searchsorted(one, two)
            shared = int((one[np.minimum(at, len(one) - 1)] == two).sum())
            keep.append(shared >= least_overlap(len(one), len(two)))
        hit = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(hit), batch.column("b").filter(hit)], ["a", "b"])


def _sets(bits):
    """(doc_id, fp, members) of the documents whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = chosen(batch, bits.value)
            if part.num_rows:
                members = [np.unique(found) for _, found, _ in sequences(part.column("text"), SIZE)]
                prints = pa.array([fingerprint(m) for m in members], pa.int64())
                packs = pa.array([m.tobytes() for m in members], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), prints, packs], ["doc_id", "fp", "members"])

    return run


def links(docs: DataFrame, profile: DataFrame) -> DataFrame:
    """component of each linked class (fp) of the documents in `profile` (doc_id, n, fp, sign)."""
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(_sketch(profile))
    classes = profile.filter("n > 1 AND n <= " + str(LARGEST_LIGHT * 2)).groupBy("n").agg(F.count_distinct("fp").alias("many"))
    limit = boundary([tuple(r) for r in classes.collect()])  # one row for each of the small sizes
    entries = docs.select("doc_id", "text").mapInArrow(_entries(sketch, limit), "key long, fp long, n int, at int")
    lists = saved(_shared(entries))
    # One document stands for each class; equal sets have equal signatures.
    heads = profile.filter("n > 1").groupBy("fp").agg(F.min("doc_id").alias("stand"), F.first("n").alias("n"), F.first("sign").alias("sign"))
    stands = saved(heads.join(lists.select("fp").distinct(), "fp", "left_semi"))

    def fetched(classes: DataFrame) -> DataFrame:
        """fp and members of classes, from the texts of the documents that stand for them."""
        wanted = saved(classes.join(stands, "fp").select("fp", F.col("stand").alias("doc_id")))
        if wanted.isEmpty():
            return wanted.selectExpr("fp", "cast(NULL AS binary) AS members")
        bits = id_bits(wanted, "doc_id")
        members = placed(docs, bits, "doc_id").mapInArrow(
            _sets(spark.sparkContext.broadcast(bits)), "doc_id long, fp long, members binary"
        )
        one = members.join(wanted.withColumnRenamed("doc_id", "stand"), "fp").filter("doc_id = stand")
        found = saved(one.select("fp", "members").dropDuplicates(["fp"]))
        dropped(wanted)
        return found

    def promising(pairs: DataFrame) -> DataFrame:
        left = stands.select(F.col("fp").alias("a"), "n", F.col("sign").alias("x"))
        right = stands.select(F.col("fp").alias("b"), F.col("n").alias("m"), F.col("sign").alias("y"))
        joined = _ordered(pairs).join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
        return saved(joined.mapInArrow(_promising, "a long, b long"))

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("fp").alias("a"), F.col("members").alias("x"))
        right = sets.select(F.col("fp").alias("b"), F.col("members").alias("y"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return saved(joined.mapInArrow(_compared, "a long, b long"))

    known = spark.createDataFrame([], "node long, component long")
    sets, fetches = spark.createDataFrame([], "fp long, members binary"), []
    for turn in range(len(REACH) + 1):
        if turn or not REACH:
            following = saved(_open(lists, known, REACH[turn - 1] if turn else 0))
            dropped(lists)
            lists = following
            if lists.isEmpty():
                break
        now = lists if turn else lists.withColumn("component", F.col("fp"))
        pairs = promising(_chained(now, turn) if turn < len(REACH) else _crossing(now))
        if pairs.isEmpty():
            dropped(pairs)
            continue
        held = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
        fetches.append(fetched(held.join(sets.select("fp"), "fp", "left_anti")))
        sets = sets.union(fetches[-1])
        agreed = verified(pairs, sets)
        merged = _merged(known, agreed)
        dropped(pairs, agreed, known)
        known = merged
    dropped(lists, stands, *fetches)
    return known.select(F.col("node").alias("fp"), "component")


def _merged(known: DataFrame, found: DataFrame) -> DataFrame:
    """Components after more links: only the labels at the ends of the links are connected anew."""
    ends = found.select(F.col("a").alias("node")).union(found.select("b")).distinct()
    nodes = known.union(ends.join(known, "node", "left_anti").select("node", F.col("node").alias("component")))
    nodes = saved(nodes)
    named = found.join(nodes.select(F.col("node").alias("a"), F.col("component").alias("x")), "a")
    named = named.join(nodes.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
    upper = connected(named.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    renamed = nodes.join(upper.select(F.col("node").alias("component"), F.col("component").alias("upper")), "component", "left")
    merged = saved(renamed.select("node", F.coalesce("upper", "component").alias("component")))
    dropped(nodes, upper)
    return merged


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links, of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = saved(texts.mapInArrow(_profile, "doc_id long, n long, fp long, sign binary, part int, counts binary"))
    rows = found.filter("part IS NULL").select("doc_id", "n", "fp")
    known = links(texts.filter("doc_id IS NOT NULL"), found.filter("part IS NOT NULL OR doc_id IS NOT NULL"))
    named = rows.join(known, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    takes_part = F.expr("n > 0 AND doc_id IS NOT NULL")
    named = saved(named.select("doc_id", "n", F.when(takes_part, F.col("component")).alias("component")))
    heads = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("head"))
    return named.join(heads, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("head", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` without the documents that a smaller id represents; all rows of a remaining id stay."""
    gone = near_duplicates(docs).filter("component_id < doc_id").select(F.col("doc_id").alias("gone")).distinct()
    rows = packed(docs, id=F.col("doc_id").cast("long"))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")


def query(spark, folder):
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
