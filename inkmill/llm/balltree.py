"""Exact top-k by inner product: one ball tree per shard, searched by branch and bound.

Vectors are dealt over shards of bounded size by hash. A task builds the shard's ball tree and writes it as one row. Queries
are dealt into blocks of bounded size. A block walks a tree in the order of the nodes' upper bounds of the inner product,
q . centre + |q| * radius; it leaves out each node whose bound is below the current kth score of every query of the block. Each
block first searches one shard. The kth scores found there are shared with the searches of all other shards, which return
only what can still be among the best.

Blocks and shards meet in cells: some trees and some blocks, both of bounded bytes. A task gets each tree of its cell once, as a
row of its own, and then the blocks, one after the other, which search all trees of the cell with one list of the best.

Defined results: rows without a vector or with an empty one, or with null or non-finite components, take no part; a row that is repeated as a whole
counts once; rows of a query's own id are no candidates for it; ties go to the smaller id; null ids take no part; vectors of
different length are only compared within their length; empty tables give empty results. Scores are exact; those of
candidates that do not fit 64 bits are an error. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.common import dropped, saved, table

SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 256, 128
#: Components that the trees, and those that the blocks of a cell hold at most (a single tree or block may be larger).
CELL_COMPONENTS = 1 << 23
#: Cells for each core at least, where there are as many blocks and shards; partitions at most.
CELLS_A_CORE, MOST_PARTS = 4, 10_000
#: Below all scores.
NONE = -(2**63)

_TREES = "dim int, shard int, ids binary, vectors binary, bounds binary, centres binary, radii binary, children binary"
_BLOCKS = "dim int, block int, ids binary, vectors binary, floors binary"
_FOUND = "query_id long, vec_id long, score long"


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (floor(scale * x) of each component, as double) and dim of the rows that take part."""
    double = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), double.alias("v"))
        .filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~bad)
        .select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"), F.size("v").alias("dim"))
    )


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _largest(vectors: np.ndarray) -> int:
    return int(np.abs(vectors).max()) if vectors.size else 0


def _narrow(vectors: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as hold all of them."""
    most = _largest(vectors)
    return vectors.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64).tobytes()


def _wide(packed: bytes, rows: int, dim: int) -> np.ndarray:
    """The vectors that `_narrow` wrote, as they were written."""
    kind = {2: np.int16, 4: np.int32, 8: np.float64}[len(packed) // (rows * dim)]
    return np.frombuffer(packed, kind).reshape(rows, dim)


def _whole(vectors: np.ndarray) -> np.ndarray:
    """Components as 64-bit integers."""
    if _largest(vectors) >= 2**63:
        raise OverflowError("components of these vectors do not fit 64 bits")
    return vectors.astype(np.int64)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as 64-bit integers where they may not fit the 53 bits of a float."""
    largest = _largest(queries) * _largest(vectors) * queries.shape[1]
    if largest < 2**53:
        return queries @ vectors.T
    one, two = _whole(queries), _whole(vectors)
    if largest < 2**63:
        return one @ two.T
    # Sums of Python's integers tell which scores fit.
    found = one.astype(object) @ two.astype(object).T
    if max(found.max(), -found.min()) >= 2**63:
        raise OverflowError("inner products of these vectors do not fit 64 bits")
    return found.astype(np.int64)


def build(vectors: np.ndarray, leaf: int = LEAF_ROWS):
    """Order of rows, and per node: first and last row, centre, radius and the two children (-1 for a leaf)."""
    order = np.arange(len(vectors))
    bounds, centres, radii, children = [], [], [], []
    todo = [(0, len(vectors), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        part = vectors[order[lo:hi]]
        centre = part.mean(axis=0)
        away = np.sqrt(((part - centre) ** 2).sum(axis=1))
        node = len(bounds)
        bounds.append((lo, hi))
        centres.append(centre)
        radii.append(away.max())
        children.append([-1, -1])
        if parent >= 0:
            children[parent][side] = node
        if hi - lo <= leaf or radii[-1] == 0:
            continue
        # Split halfway between two points far from each other.
        one = part[away.argmax()]
        other = part[((part - one) ** 2).sum(axis=1).argmax()]
        along = part @ (other - one)
        order[lo:hi] = order[lo:hi][np.argsort(along, kind="stable")]
        middle = (lo + hi) // 2
        todo += [(lo, middle, node, 0), (middle, hi, node, 1)]
    return order, np.array(bounds, np.int64), np.array(centres), np.array(radii), np.array(children, np.int64)


def _tree_row(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    vectors = _matrix(rows["v"])
    order, bounds, centres, radii, children = build(vectors)
    ids = rows["vec_id"].to_numpy(np.int64)[order]
    return pd.DataFrame([{
        "dim": key[0], "shard": key[1], "ids": ids.tobytes(), "vectors": _narrow(vectors[order]),
        "bounds": bounds.tobytes(), "centres": centres.tobytes(), "radii": radii.tobytes(), "children": children.tobytes(),
    }])


def _block_row(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    ids = rows["vec_id"].to_numpy(np.int64)
    floors = rows["floor"].to_numpy(np.int64) if "floor" in rows else np.full(len(ids), NONE)
    return pd.DataFrame([{
        "dim": key[0], "block": key[1], "ids": ids.tobytes(), "vectors": _narrow(_matrix(rows["v"])), "floors": floors.tobytes()
    }])


class Best:
    """The k best of each query of a block so far; `floor` is the score a candidate must reach."""

    def __init__(self, ids: np.ndarray, floors: np.ndarray, k: int):
        self.own, self.k, self.floor = ids, k, floors.copy()
        # Integers where floors are: they hold scores beyond 53 bits.
        self.none = -np.inf if floors.dtype.kind == "f" else NONE
        self.scores = np.full((len(ids), k), self.none, floors.dtype)
        self.ids = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of the queries `which` with the rows `ids`."""
        scores = scores.astype(self.scores.dtype, copy=False)
        hit = scores >= self.floor[which][:, None]
        some = hit.any(axis=1)
        which, hit, scores = which[some], hit[some], scores[some]
        if not len(which):
            return
        # Only rows that some query may take are put in order.
        wanted = hit.any(axis=0)
        ids, scores = ids[wanted], scores[:, wanted]
        scores = np.where(ids[None, :] == self.own[which][:, None], scores.dtype.type(self.none), scores)
        all_scores = np.hstack([self.scores[which], scores])
        all_ids = np.hstack([self.ids[which], np.broadcast_to(ids, scores.shape)])
        best = np.lexsort((all_ids, -all_scores if self.none != NONE else ~all_scores), axis=1)[:, : self.k]
        self.scores[which] = np.take_along_axis(all_scores, best, 1)
        self.ids[which] = np.take_along_axis(all_ids, best, 1)
        self.floor[which] = np.maximum(self.floor[which], self.scores[which][:, -1])


def search(queries: np.ndarray, best: Best, ids, vectors, bounds, centres, radii, children) -> None:
    """Walk one tree, highest bound first; queries leave a branch as soon as its bound is below their floor."""
    lengths = np.sqrt((queries**2).sum(axis=1))
    reach = radii * (1 + 1e-9) + 1e-9 * (1 + np.sqrt((centres**2).sum(axis=1)))
    upper = queries @ centres.T + lengths[:, None] * reach + 1e-6
    asked = queries.astype(best.scores.dtype, copy=False) if best.none != NONE else queries
    everyone = np.arange(len(queries))
    heap = [(-upper[:, 0].max(), 0, everyone)]
    while heap:
        _, node, which = heapq.heappop(heap)
        which = which[upper[which, node] >= best.floor[which]]
        if not len(which):
            continue
        if children[node][0] < 0:
            lo, hi = bounds[node]
            scores = products(queries[which], vectors[lo:hi]) if best.none == NONE else asked[which] @ vectors[lo:hi].T
            best.add(which, ids[lo:hi], scores)
            continue
        for child in children[node]:
            heapq.heappush(heap, (-upper[which, child].max(), int(child), which))


def _tree(row: dict) -> tuple:
    """The largest component of a tree, and what `search` takes."""
    read = lambda name, kind: np.frombuffer(row[name], kind)
    ids, dim = read("ids", np.int64), row["dim"]
    vectors = _wide(row["vectors"], len(ids), dim)
    largest = int(np.abs(vectors.astype(np.float64)).max())
    # Floats of 24 bits hold 16-bit numbers.
    vectors = vectors.astype(np.float32 if vectors.dtype == np.int16 else np.float64)
    return largest, (
        ids, vectors, read("bounds", np.int64).reshape(-1, 2), read("centres", np.float64).reshape(-1, dim),
        read("radii", np.float64), read("children", np.int64).reshape(-1, 2),
    )


def _block_best(row: dict, trees: list[tuple], k: int) -> pa.RecordBatch:
    """What the queries of a block find in the trees of a cell and can be among their best."""
    ids, floors = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["floors"], np.int64)
    queries = _wide(row["vectors"], len(ids), row["dim"]).astype(np.float64)
    # Scores, and sums of a part of their terms, are whole numbers below this: which floats hold them?
    largest = _largest(queries) * max(t[0] for t in trees) * row["dim"]
    if largest < 2**53:
        floors = np.where(floors == NONE, -np.inf, floors.astype(np.float64)).astype(np.float32 if largest < 2**24 else np.float64)
    best = Best(ids, floors, k)
    for _, tree in trees:
        search(queries, best, *tree)
    at, rank = np.nonzero((best.scores > best.none) & (best.scores >= best.floor[:, None]))
    columns = [ids[at], best.ids[at, rank], best.scores[at, rank].astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def _searched(k: int):
    """Rows of a cell come together, its trees first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, trees = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["cell"] != cell:
                    cell, trees = row["cell"], {}
                if row["block"] is None:
                    trees.setdefault(row["dim"], []).append((row["shard"], _tree(row)))
                elif some := [tree for shard, tree in trees.get(row["dim"], []) if shard != row["done"]]:
                    yield _block_best(row, some, k)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of `vectors` for each of `queries`.

    Both come from `integer_vectors`. Every row of queries is searched in every shard, in blocks.
    """
    rows = saved(vectors.distinct())
    asked = saved(queries.distinct())
    n, dim = rows.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    shards = max(1, -(-n // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    by_hash = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    trees = saved(rows.withColumn("shard", by_hash(shards)).groupBy("dim", "shard").applyInPandas(_tree_row, _TREES))
    dropped(rows)
    dealt = asked.withColumn("block", by_hash(blocks))
    home = F.pmod("block", F.lit(shards)).cast("int")

    # Cells are groups of trees by chunks of blocks. Blocks are few, so they go to more places than trees.
    wanted = CELLS_A_CORE * vectors.sparkSession.sparkContext.defaultParallelism
    together = max(1, min(shards // wanted, CELL_COMPONENTS // (SHARD_ROWS * dim)))
    groups = -(-shards // together)
    chunks = max(-(-blocks // max(1, CELL_COMPONENTS // (BLOCK_ROWS * dim))), min(blocks, -(-wanted // groups)))

    def searched(some_trees: DataFrame, some_blocks: DataFrame, cells: int) -> DataFrame:
        """Every block against all trees of its cell but that of the shard `done`."""
        met = some_trees.unionByName(some_blocks, allowMissingColumns=True)
        parts = min(cells, MOST_PARTS)
        placed = met.repartitionById(parts, F.pmod("cell", F.lit(parts)).cast("int"))
        return placed.sortWithinPartitions("cell", F.col("block").isNotNull(), "shard").mapInArrow(_searched(k), _FOUND)

    in_blocks = dealt.groupBy("dim", "block").applyInPandas(_block_row, _BLOCKS)
    at_home = trees.filter(F.col("shard") < min(shards, blocks)).withColumn("cell", F.col("shard").cast("long"))
    asking = in_blocks.withColumn("cell", home.cast("long")).withColumn("done", F.lit(-1))
    first = saved(_best(searched(at_home, asking, min(shards, blocks)), k).drop("rank"))
    floors = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(NONE)).cast("long").alias("floor")
    )
    seeded = dealt.join(floors, F.col("vec_id") == F.col("query_id"), "left").withColumn(
        "floor", F.coalesce("floor", F.lit(NONE).cast("long"))
    )
    in_blocks = saved(seeded.groupBy("dim", "block").applyInPandas(_block_row, _BLOCKS))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    everywhere = trees.withColumn("chunk", chunk).withColumn("cell", F.floor(F.col("shard") / together) * chunks + F.col("chunk")).drop("chunk")
    asking = in_blocks.withColumn("done", home).withColumn("group", group)
    asking = asking.withColumn("cell", F.col("group").cast("long") * chunks + F.pmod("block", F.lit(chunks))).drop("group")
    rest = searched(everywhere, asking, groups * chunks)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, folder):
    rows = integer_vectors(table(spark, folder, "embeddings"))
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


ORACLE = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id != c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
