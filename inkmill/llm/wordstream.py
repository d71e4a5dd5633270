"""Words of many texts at once, as arrays: byte classes instead of a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are taken apart at once.
PART_BYTES = 4 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def parts(batch: pa.RecordBatch, name: str = "text", most_rows: int = 1024, most_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about `most_bytes` of text; a longer text is a part of its own."""
    column = batch.column(name)
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, done + most_bytes, side="right"))
        stop = max(start + 1, min(stop, start + most_rows))
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def words(texts: pa.Array, kinds: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Number, dictionary, text, first and last byte of every word of `texts`, A-Z lower-cased.

    A word is a maximal run of bytes of kind 0, so classes of ASCII characters work on UTF-8 as it is; a null has no words. The
    first and last bytes are places in all texts put together, whose kinds are the last array returned.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = kinds[raw]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(raw)]
    first[borders] = inside[borders]
    starts = np.flatnonzero(first)
    in_word = np.cumsum(inside)
    # Each word's length is the number of its bytes up to the next word's first byte.
    before = in_word[starts] - 1 if len(starts) else np.zeros(0, np.int64)
    total = int(in_word[-1]) if len(raw) else 0
    bounds = np.append(before, total).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(LOWER[raw[inside]].tobytes())]
    )
    coded = flat.dictionary_encode()
    numbers = np.asarray(coded.indices, dtype=np.int64)
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    return numbers, coded.dictionary, text_of, starts, kind
