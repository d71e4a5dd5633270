"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

A text is split by the vocabulary's pattern. A piece that is a vocabulary entry as a whole is resolved by a minimal perfect
hash; any other piece is merged from its bytes, which are linked to their neighbours, by a heap of candidate merges, lowest
rank and leftmost first. Ids are kept as little-endian unsigned 32-bit integers. The vocabulary and the hash are built once on
the driver and broadcast: their size is that of the vocabulary file, whatever the documents. Texts are encoded where they are
read; nothing is shuffled. A worker keeps the pieces it has met from one batch and one task to the next. What is decoded right
after it was encoded is decoded in the same pass over the rows, so the ids, which can be several times as long as the texts, do
not go to a second worker.

Defined results: a null or empty text has no ids and decodes to empty bytes; repeated rows are encoded alike, one row each; a
null id stays null; an empty table gives an empty result. Other columns are ignored. Memory is that of one text's pieces
beside a bounded table of pieces already encoded (about 100 MB a worker when it is full; `encode` can be given a share of it).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inkmill.llm.common import whole_text

#: Pieces whose ids a worker remembers, from one task to the next: those it met again, and those it met once.
REMEMBERED, ONCE = 300_000, 300_000
NO_RANK = 1 << 31


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """As many slots as keys, one for each key: buckets of a first hash, each with the displacement that fits its keys."""

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) * 2 // 5)
        self.displacement = [0] * self.buckets
        self.slots: list[int] = [-1] * self.n
        by_bucket: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            by_bucket.setdefault(h % self.buckets, []).append((h, i))
        free = set(range(self.n))
        for bucket, members in sorted(by_bucket.items(), key=lambda kv: -len(kv[1])):
            d = next(iter(free)) if len(members) == 1 else 0
            if len(members) == 1:
                # A single key can go to any free slot; negative numbers name the slot itself.
                places, d = [d], -d - 1
            else:
                while True:
                    places = [self._place(h, d) for h, _ in members]
                    if len(set(places)) == len(places) and free.issuperset(places):
                        break
                    d += 1
            self.displacement[bucket] = d
            for place, (_, i) in zip(places, members, strict=True):
                self.slots[place] = i
            free.difference_update(places)

    def _place(self, h: int, d: int) -> int:
        return ((((h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF) >> 32) % self.n

    def __call__(self, key: bytes) -> int:
        """The only index at which the key can be."""
        h = xxhash.xxh64_intdigest(key)
        d = self.displacement[h % self.buckets]
        return self.slots[-d - 1 if d < 0 else self._place(h, d)]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, share: float = 1):
        self.pattern, self.share = pattern, share
        self.ranks = ranks
        self.tokens = list(ranks)
        self.hash = PerfectHash(self.tokens)
        self.packed = [rank.to_bytes(4, "little") for rank in ranks.values()]
        self.packed_rank = dict(zip(ranks.values(), self.packed, strict=True))
        self.pairs = [ranks.get(bytes((a, b)), NO_RANK) for a in range(256) for b in range(256)]
        self.known, self.split = Known(self.piece, self.share), regex.compile(pattern).findall

    def __getstate__(self) -> dict:
        """Without what it has met: a worker gathers that by itself."""
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "split")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.known, self.split = Known(self.piece, self.share), regex.compile(self.pattern).findall

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece by repeated merges. `end[i]` is where the part that starts at i ends, 0 inside a part."""
        n, ranks, pairs = len(piece), self.ranks, self.pairs
        end = list(range(1, n + 1))
        before = list(range(-1, n))
        heap = []
        for i in range(n - 1):
            rank = pairs[piece[i] << 8 | piece[i + 1]]
            if rank != NO_RANK:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            before[stop] = i
            if stop < n:
                rank = ranks.get(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if i:
                left = before[i]
                rank = ranks.get(piece[left:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def piece(self, text: str) -> bytes:
        piece = text.encode()
        i = self.hash(piece)
        if self.tokens[i] == piece:
            return self.packed[i]
        return b"".join(map(self.packed_rank.__getitem__, self.merged(piece)))

    def texts(self, texts: Iterator[str]) -> Iterator[bytes]:
        for text in texts:
            yield b"".join(map(self.known.__getitem__, self.split(text)))
            self.known.trim()


class Known(dict):
    """Results of pieces that were met at least twice; those met once are kept beside them until many others have been met.

    Most pieces of a text are common ones, and most different pieces are met once: they must not drive out the common ones.
    When half the places are taken, what is not met again until the other half is taken too is forgotten.
    """

    def __init__(self, make, share: float = 1):
        self.make, self.share = make, share
        self.fresh, self.older, self.past = {}, {}, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.past.pop(piece, None) or self.fresh.pop(piece, None) or self.older.pop(piece, None)
        if found is None:
            found = self.fresh[piece] = self.make(piece)
        else:
            self[piece] = found
        return found

    def trim(self) -> None:
        if len(self.fresh) > ONCE * self.share // 2:
            self.older, self.fresh = self.fresh, {}
        if len(self) > REMEMBERED * self.share // 2:
            self.past = dict(self)
            self.clear()


def encode(docs: DataFrame, ranks_path: str, pattern: str, share: float = 1) -> DataFrame:
    """doc_id, n_tokens and ids (binary) of each document.

    `share` of the places for remembered pieces is used: less memory and more work where workers hold much else.
    """
    rows = docs.select("doc_id", whole_text().alias("text"))
    encoder = docs.sparkSession.sparkContext.broadcast(Encoder(read_ranks(ranks_path), pattern, share))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = list(encoder.value.texts(x.as_py() for x in part.column("text")))
                n = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    encoded = rows.mapInArrow(run, schema)
    encoded.made_by = rows, run
    return encoded


def slices(batch: pa.RecordBatch, rows: int = 200) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that what is made of it stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


class Decoder:
    """Tokens one after another in the order of their ranks, which need not be without gaps."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.ranks = np.array([ranks[t] for t in tokens], np.uint32)
        self.tokens = pa.array(tokens, pa.large_binary())

    def texts(self, ids: pa.Array) -> pa.Array:
        """What each binary of little-endian ids decodes to. An unknown id is an error."""
        packs = [x.as_py() for x in ids]
        flat = np.frombuffer(b"".join(packs), "<u4")
        at = np.searchsorted(self.ranks, flat)
        if len(flat) and (at.max() == len(self.ranks) or (self.ranks[at] != flat).any()):
            raise KeyError("an id is not in the vocabulary")
        # The tokens that were taken lie one after another: each text is a stretch of their bytes.
        taken = self.tokens.take(pa.array(at))
        _, places, data = taken.buffers()
        ends = np.frombuffer(places, np.int64, len(taken) + 1, taken.offset * 8) if len(taken) else np.zeros(1, np.int64)
        stops = ends[np.cumsum([0, *(len(x) // 4 for x in packs)])]
        joined = memoryview(data) if data else b""
        return pa.array([bytes(joined[a:b]) for a, b in zip(stops[:-1], stops[1:], strict=True)], pa.binary())


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Add decoded (binary) to rows with ids."""
    decoder = encoded.sparkSession.sparkContext.broadcast(Decoder(read_ranks(ranks_path)))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    rows, before = getattr(encoded, "made_by", (encoded, lambda batches: batches))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in before(batches):
            for part in slices(batch):
                yield part.append_column("decoded", decoder.value.texts(part.column("ids")))

    return rows.mapInArrow(run, schema)


def query(spark, folder):
    import public_tokenizers
    from pyspark.sql import functions as F

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    done = decode(encode(docs, path, public_tokenizers.PATTERN), path)
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
