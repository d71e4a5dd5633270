"""Which rows of a large table have a key in a known set, without shuffling the rows.

A join by key would send whole documents through a shuffle as soon as the key table is too large to broadcast. Here only keys are
shuffled, once, to split the documents' own keys into two sets. The smaller set goes into a bitmap by hash; keys of the other
set that hit it by chance go into a second bitmap, keys of the first set that hit that one into a third, and so on until no
chance hit is left. As every key of the table took part, the chain of bitmaps answers exactly, and it is small: each level holds
about an eighth of the keys of the one before. Bitmaps enter the plan as scalar subqueries, as Spark's own runtime filters do.

Beyond a bound on the bitmaps' size the answer comes from a join by key instead; both give the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.sources.staging import kept

#: Bits of a bitmap for each of its keys; a key that is not in it hits it with a chance of about one in nine.
BITS_PER_KEY = 8
#: Bits of the smallest bitmap; small sets seldom need a second level.
LEAST_BITS = 1 << 22
#: All bitmaps of the first level together; later levels are smaller.
MOST_BYTES = 32 << 20
_PART_BITS = 32768  # of one value of bitmap_construct_agg


def _place(key: str, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(bits))


def _bitmap(keys: DataFrame, key: str, seed: int, bits: int) -> DataFrame:
    """One row with one binary value of `bits` bits."""
    place = keys.select(_place(key, seed, bits).alias("place"))
    parts = place.groupBy(F.expr(f"cast(place DIV {_PART_BITS} AS int)").alias("part")).agg(
        F.bitmap_construct_agg((F.col("place") % _PART_BITS).cast("int")).alias("bits")
    )
    every = keys.sparkSession.range(bits // _PART_BITS).select(F.col("id").cast("int").alias("part")).join(parts, "part", "left")
    text = F.coalesce(F.hex("bits"), F.lit("00" * (_PART_BITS // 8)))
    ordered = F.array_sort(F.collect_list(F.struct("part", text.alias("t"))))
    return kept(every.agg(F.unhex(F.array_join(F.transform(ordered, lambda s: s["t"]), "")).alias("bits")))


def _hit(bitmap: DataFrame, key: str, seed: int, bits: int) -> Column:
    place = _place(key, seed, bits)
    byte = F.conv(F.hex(F.substring(bitmap.select("bits").scalar(), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) > 0


class Exceeded(ValueError):
    """The first level would be larger than MOST_BYTES."""


def member_test(inside: DataFrame, outside: DataFrame, key: str) -> Column:
    """A condition on `key`: true for every key of `inside`, false for every key of `outside`, and of no meaning for others.

    Both are tables with a key column that is never null. Raises Exceeded if both are too large.
    """
    n_inside, n_outside = inside.count(), outside.count()
    if not n_inside or not n_outside:
        return F.lit(bool(n_inside))
    if n_inside > n_outside:
        return ~member_test(outside, inside, key)
    # So many bitmaps at the first level that chance hits are fewer than the keys in it.
    slices = max(1, math.ceil(math.log(n_outside / n_inside) / math.log(BITS_PER_KEY)))
    size = lambda n: _PART_BITS * -(-max(LEAST_BITS, BITS_PER_KEY * n) // _PART_BITS)
    if slices * size(n_inside) // 8 > MOST_BYTES:
        raise Exceeded(f"{n_inside} keys against {n_outside}")

    tests, seed, mine, others = [], 0, inside, outside
    n_mine, n_others = n_inside, n_outside
    while True:
        bits, test = size(n_mine), F.lit(True)
        for _ in range(slices):
            seed += 1
            test = test & _hit(_bitmap(mine, key, seed, bits), key, seed, bits)
        tests.append(test)
        if not n_others:
            break
        chance = kept(others.filter(test))
        n_mine, n_others, slices = chance.count(), n_mine, 1
        if not n_mine:
            break
        mine, others = chance, mine
    # A key that misses level i belongs to the other side than that level's; one that hits all belongs to the last.
    answer = F.lit(len(tests) % 2 == 1)
    for level in reversed(range(len(tests))):
        answer = F.when(tests[level], answer).otherwise(F.lit(level % 2 == 1))
    return answer


def marked(rows: DataFrame, inside: DataFrame, outside: DataFrame, key: str, name: str) -> DataFrame:
    """`rows` with a column that says whether the key is in `inside`; the keys of all rows are in one of both tables."""
    try:
        return rows.withColumn(name, member_test(inside, outside, key))
    except Exceeded:
        flags = inside.select(key, F.lit(True).alias(name))
        return rows.join(flags, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
