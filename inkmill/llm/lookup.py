"""Find the rows of a few ids in a large table without shuffling its texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each wanted id, and the most bits a map may have: 2**27 bits are 16 MB.
BITS_PER_ID, MOST_BITS = 16, 1 << 27


def id_bits(wanted: DataFrame, name: str) -> np.ndarray:
    """A bit map of the hashed ids of a table, of bounded size. It only spares work on other rows: a full map lets more of
    them pass, and the join by id that follows drops them."""
    count, bits = wanted.count(), 1 << 15
    while bits < BITS_PER_ID * count and bits < MOST_BITS:
        bits *= 2
    place = F.pmod(F.xxhash64(name), F.lit(bits))
    parts = (
        wanted.select(place.alias("p"))
        .groupBy(F.shiftright("p", 15).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p").bitwiseAND(F.lit(32767)) + 1)).alias("bits"))
    )
    found = np.zeros(bits // 8, np.uint8)
    for r in parts.toLocalIterator():
        found[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return found


def placed(rows: DataFrame, bits: np.ndarray, name: str) -> DataFrame:
    """The id, the text, and the place of the id in the bit map."""
    return rows.select(name, "text", F.pmod(F.xxhash64(name), F.lit(len(bits) * 8)).alias("place"))


def chosen(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """The rows whose bit is set."""
    place = batch.column("place").to_numpy()
    return batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))


def passing(bits, name: str, remembered: int = 200_000):
    """Rows whose bit is set; each id once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            part = chosen(batch, bits.value)
            fresh = []
            for i in part.column(name).to_pylist():
                fresh.append(i not in seen)
                if len(seen) >= remembered:
                    seen.clear()
                seen.add(i)
            part = part.filter(pa.array(fresh, pa.bool_()))
            if part.num_rows:
                yield part.select([name, "text"])

    return run
