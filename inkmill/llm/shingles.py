"""Word and shingle hashes of many texts at once, for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed together; a longer text is hashed by itself.
TOGETHER = 1 << 20

_RNG = np.random.default_rng(20240229)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_STEPS = [np.uint64(int(x) | 1) for x in _RNG.integers(1, 2**62, 8)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (64-bit finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ROOT, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z in lower case) in bytes, and where each starts."""
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    lengths = ends - starts
    inside = np.flatnonzero(~space)
    offset = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _VALUE[data[inside]] * _powers(int(lengths.max()))[offset]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mixed(sums + lengths.astype(np.uint64) * _STEPS[7]), starts


def sequences(texts: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray, int]]:
    """Row number, shingle hashes in text order and number of words, of each text.

    With fewer words than `size`, the whole sequence is the one shingle; without words there is none.
    """
    start = 0
    while start < len(texts):
        stop, held = start, 0
        parts = []
        while stop < len(texts) and (not parts or held < TOGETHER):
            raw = texts[stop].as_buffer()
            parts += [np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), np.array([10], np.uint8)]
            held += len(parts[-2]) + 1
            stop += 1
        data = np.concatenate(parts)
        words, where = word_hashes(data)
        limits = np.cumsum([len(a) + 1 for a in parts[::2]])
        cuts = np.concatenate(([0], np.searchsorted(where, limits)))
        if len(words) >= size:
            joined = np.zeros(len(words) - size + 1, np.uint64)
            for k in range(size):
                joined += words[k : len(words) - size + 1 + k] * _STEPS[k]
            joined = mixed(joined)
        for i in range(stop - start):
            a, b = int(cuts[i]), int(cuts[i + 1])
            if b - a >= size:
                yield start + i, joined[a : b - size + 1], b - a
            elif b > a:
                short = (words[a:b] * np.array(_STEPS[: b - a])).sum(dtype=np.uint64, keepdims=True)
                yield start + i, mixed(short ^ np.uint64(b - a)), b - a
            else:
                yield start + i, np.zeros(0, np.uint64), 0
        start = stop


def fingerprint(distinct: np.ndarray) -> int:
    """One signed 64-bit number for a set or sequence of hashes given in a fixed order."""
    if not len(distinct):
        return 0
    places = mixed(np.arange(1, len(distinct) + 1, dtype=np.uint64) * _STEPS[6])
    total = mixed(distinct ^ places).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(len(distinct))
    return int(mixed(total).view(np.int64)[0])
