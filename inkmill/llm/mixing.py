"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash. A source that may give B words of its S is repeated floor(B / S) times in full, and the
rest comes from the documents whose hash lies below a threshold. The threshold is found without sorting documents: words
are summed by source and leading hash bits, the bucket in which the running sum passes the rest is the boundary, and only
its documents are summed again by the next bits, until the hash is used up. Thresholds grow with the budget, so the mix for
a smaller budget is part of the mix for a larger one.

Defined results: a null text has size 0; null sources are one source that comes last; a null id hashes like an empty one;
rows that repeat an id share their hash and are taken or left together; a source without words has target 0 and is never
taken; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.common import WORD, packed, saved, whole_text

#: The hash has LEVELS * BITS bits, so many hexadecimal digits of an MD5 sum.
BITS, LEVELS = 12, 5
DIGITS = BITS * LEVELS // 4

_HASH = f"cast(conv(substr(md5(coalesce(cast(doc_id AS string), '')), 1, {DIGITS}), 16, 10) AS bigint)"
#: Null and text sources as one string that is never null.
_KEY = "coalesce(concat('s', cast(source AS string)), 'n')"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, key, hash and size (words) of every document."""
    return docs.select(
        "doc_id",
        "source",
        F.expr(_KEY).alias("key"),
        F.expr(_HASH).alias("hash"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("size"),
    )


def _ranked(totals: DataFrame) -> DataFrame:
    """Add each source's place in the order of code points, null last; no task sees all sources."""
    placed = totals.repartitionByRange(F.col("source").isNull(), "source").sortWithinPartitions(F.col("source").isNull(), "source")
    placed = saved(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("start"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(starts, "part").withColumn("place", F.expr("before + at - start")).drop("part", "at", "start", "before")


def _level(sources: DataFrame, words: float, cap: int) -> float:
    """Words per unit of weight at which the sources' capped shares add up to `words`.

    Sources whose share exceeds their cap are set to it and what they leave is shared again, until none is above. The
    driver sees three sums a round.
    """
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= cap * F.col("source_size")
        free = F.when(~full, F.col("weight"))
        if level == 0:
            full, free = F.lit(False), F.col("weight")
        row = sources.agg(F.sum(F.when(full, cap * F.col("source_size"))).alias("held"), F.sum(free).alias("weight")).first()
        if not row.weight:
            return level
        found = (words - (row.held or 0)) / row.weight
        if found <= level:
            return level
        level = found


def targets(sizes: DataFrame, weights: Sequence[int], budgets: Sequence[float], cap: int) -> DataFrame:
    """Per source and budget (a share of all words): target words, full repeats, and the rest to be taken by threshold."""
    totals = saved(
        sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = saved(_ranked(totals).withColumn("weight", weight))
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    some = sources.filter("source_size > 0")
    levels = [(float(b), _level(some, words * b, cap)) for b in budgets]
    shares = F.explode(F.array(*[F.struct(F.lit(b).alias("budget"), F.lit(v).alias("level")) for b, v in levels])).alias("s")
    target = F.least(F.col("weight") * F.col("level"), (cap * F.col("source_size")).cast("double"))
    rows = sources.select("*", shares).select("key", "source_size", "weight", "s.budget", "s.level").withColumn("target", target)
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return rows.withColumn("repeats", repeats.cast("bigint")).select(
        "key", "source_size", "budget", "target", "repeats", F.expr("target - repeats * source_size").alias("rest")
    )


def _passed(sums: DataFrame) -> DataFrame:
    """The bucket of each source and budget in which the running sum reaches the rest."""
    so_far = Window.partitionBy("key", "budget").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sums.withColumn("upto", F.col("before") + F.sum("words").over(so_far))
        .withColumn("before", F.col("upto") - F.col("words"))
        .filter("before < rest AND rest <= upto")
        .select("key", "budget", "rest", "bucket", "before", "words")
    )


def thresholds(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), budgets: Sequence[float] = (1.0,), cap: int = 3
) -> DataFrame:
    """key, budget, source_size, target, repeats and edge: hashes below the edge are taken once more than repeats."""
    wanted = saved(targets(sizes, weights, budgets, cap))
    top = BITS * (LEVELS - 1)
    first = sizes.groupBy("key", F.shiftright("hash", top).alias("bucket")).agg(F.sum("size").alias("words"))
    goal = wanted.filter("rest > 0").select("key", "budget", "rest")
    edge = saved(_passed(first.join(goal, "key").withColumn("before", F.lit(0).cast("bigint"))))
    # Only the documents of boundary buckets are looked at again, about one in 4096 of a source.
    inside = edge.select("key", "budget", "bucket")
    close = saved(
        sizes.select("key", "hash", "size", F.shiftright("hash", top).alias("bucket")).join(inside, ["key", "bucket"])
    ).drop("bucket")
    for level in range(1, LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        known = edge.select("key", "budget", "rest", "before", F.col("bucket").alias("outer"))
        finer = F.shiftright("hash", shift)
        sums = (
            close.withColumn("outer", F.shiftright("hash", shift + BITS))
            .groupBy("key", "budget", "outer", finer.alias("bucket"))
            .agg(F.sum("size").alias("words"))
            .join(known, ["key", "budget", "outer"])
        )
        edge = _passed(sums)
    # The last bucket is one hash value: it is taken if that brings the sum nearer to the target.
    nearer = F.expr("before + words - rest <= rest - before").cast("bigint")
    edges = edge.select("key", "budget", (F.col("bucket") + nearer).alias("edge"))
    return wanted.join(edges, ["key", "budget"], "left").select(
        "key", "budget", "source_size", "target", "repeats", F.coalesce("edge", F.lit(0)).alias("edge")
    )


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budgets: Sequence[float] = (1.0,), cap: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of each document for each budget."""
    sizes = saved(measured(docs))
    found = saved(thresholds(sizes, weights, budgets, cap))
    times = F.expr("repeats + cast(hash < edge AS bigint)")
    return sizes.join(found, "key").select(
        "doc_id", "source", "size", "source_size", "budget", "target", (F.col("size") * times).alias("taken")
    )


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.0, cap: int = 3) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with its own columns. Texts are not shuffled while
    the thresholds, one row a source, are small enough for Spark to broadcast."""
    found = saved(thresholds(saved(measured(docs)), weights, (budget,), cap)).select("key", "repeats", "edge")
    rows = packed(docs, key=F.expr(_KEY), hash=F.expr(_HASH)).join(found, "key")
    times = F.expr("array_repeat(0, cast(repeats + cast(hash < edge AS int) AS int))")
    return rows.select("row", F.explode(times)).select("row.*")


def query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {DIGITS}))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s
), c AS (  -- sources in the order in which they reach their cap
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         sum(source_size) OVER () AS words
  FROM r WHERE source_size > 0
), v AS (
  SELECT (words - held)::DOUBLE / free AS level FROM c WHERE (words - held)::DOUBLE / free <= 3 * source_size / weight
  ORDER BY 3 * source_size / weight, source LIMIT 1
), t AS (
  SELECT source, source_size, least(weight * level, (3 * source_size)::DOUBLE) AS target FROM r, v
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats FROM t
), q AS (
  SELECT doc_id, size, source_size, target, repeats, target - repeats * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING), 0) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       size * (repeats + CASE WHEN rest > 0 AND (upto < rest OR (upto - own < rest AND upto - rest <= rest - (upto - own))) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM q
"""
