"""Encoding of texts with a public byte-level BPE vocabulary (problem 7).

Two tiers. A pre-token that is a vocabulary entry as a whole is resolved by a
minimal perfect hash (hash and displace, one table slot per entry, the key bytes
compared). Every other pre-token is merged by rank: a heap of candidate pairs
over a doubly linked list of byte pieces, O(n log n) for long ones. The ranks that merging
asks for come from a plain dictionary: most of the pairs asked for are no entries, which it
settles without hashing their bytes twice; it shares its keys with the table.

Null and empty texts give an empty list. White space is encoded like any other
text. Repeated rows are encoded each; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-token pattern of the public vocabularies.
PATTERN = public_tokenizers.PATTERN
#: Ids after which a batch of the result is handed on.
FLUSH = 1 << 20
#: Pre-tokens remembered by a Python worker, and the longest one worth remembering.
REMEMBERED, LONGEST = 400_000, 64


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes to ids from a ``.tiktoken`` rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_WORD, _STEP, _MIX = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def _hashes(key: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(key, digest_size=12).digest()
    return int.from_bytes(d[:4], "little"), int.from_bytes(d[4:], "little")


def _slot(b: int, move: int, n: int) -> int:
    """Slot of a key after ``move`` displacements: mixed anew for each, so that a free slot is reached whatever divides ``n``."""
    x = (b + move * _STEP) & _WORD
    x = ((x ^ x >> 31) * _MIX) & _WORD
    return (x ^ x >> 29) % n


def _slots(b: np.ndarray, moves: np.ndarray, n: int) -> np.ndarray:
    x = b + moves * np.uint64(_STEP)
    x = (x ^ x >> np.uint64(31)) * np.uint64(_MIX)
    return ((x ^ x >> np.uint64(29)) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash: bucket by the first hash, one displacement a bucket, exactly ``len(keys)`` slots."""

    def __init__(self, ids: dict[bytes, int]):
        n = self.n = len(ids)
        self.buckets = max(1, n // 4)
        groups: list[list[tuple[bytes, int, int]]] = [[] for _ in range(self.buckets)]
        for key, token in ids.items():
            a, b = _hashes(key)
            groups[a % self.buckets].append((key, token, b))
        self.moves = np.zeros(self.buckets, np.int64)
        self.keys: list[bytes] = [b""] * n
        self.tokens = np.full(n, -1, np.int64)
        taken, steps = np.zeros(n, bool), np.arange(512, dtype=np.uint64)
        order = sorted(range(self.buckets), key=lambda g: -len(groups[g]))
        free = None
        for g in order:
            members = groups[g]
            if not members:
                break
            if len(members) == 1:  # the rest take free slots directly: no search at full load
                free = iter(np.flatnonzero(~taken).tolist()) if free is None else free
                slot = next(free)
                self.moves[g] = -slot - 1
                slots = [slot]
            else:
                b = np.array([m[2] for m in members], np.uint64)[:, None]
                base, slots = 0, None
                while slots is None:
                    at = _slots(b, steps + np.uint64(base), n)
                    ok = ~taken[at].any(axis=0)
                    for i in np.flatnonzero(ok).tolist():
                        if len(set(at[:, i].tolist())) == len(members):
                            self.moves[g], slots = base + i, at[:, i].tolist()
                            break
                    base += len(steps)
            for (key, token, _), slot in zip(members, slots):
                taken[slot], self.keys[slot], self.tokens[slot] = True, key, token

    def get(self, key: bytes) -> int | None:
        a, b = _hashes(key)
        move = int(self.moves[a % self.buckets])
        slot = -move - 1 if move < 0 else _slot(b, move, self.n)
        return int(self.tokens[slot]) if self.keys[slot] == key else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one pre-token, lowest rank first and leftmost among equals."""
    n = len(piece)
    left, right, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or end[j] != stop:  # one of the two was merged since
            continue
        alive[j], end[i], right[i] = False, stop, right[j]
        if right[j] < n:
            left[right[j]] = i
            if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[right[i]]))
        if left[i] >= 0 and (r := ranks.get(piece[left[i] : stop])) is not None:
            heapq.heappush(heap, (r, left[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = right[i]
    return out


class Encoder:
    def __init__(self, ids: dict[bytes, int], pattern: str = PATTERN):
        import regex

        self.ids, self.whole, self.split, self.known = ids, PerfectHash(ids), regex.compile(pattern).findall, {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def piece(self, token: str) -> tuple[int, ...]:
        raw = token.encode()
        whole = self.whole.get(raw)
        out = (whole,) if whole is not None else tuple(merge(raw, self.ids))
        if len(token) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = out
        return out

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known, extend, piece = self.known, out.extend, self.piece
        for token in self.split(text or ""):
            got = known.get(token)
            extend(got if got is not None else piece(token))
        return out


_SHARED: dict[tuple[str, str], object] = {}


def shared_encoder(spark: SparkSession, path: str):
    """Encoder broadcast once for each vocabulary and session: its size is that of the vocabulary file, whatever the corpus."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SHARED:
        _SHARED[key] = spark.sparkContext.broadcast(Encoder(vocabulary(path)))
    return _SHARED[key]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: ``key`` and ``ids`` (array of int)."""
    shared = shared_encoder(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in batches:
            ids, ends, first = [], [0], 0
            for row, value in enumerate(batch.column(1)):
                ids += encoder.encode(value.as_py())
                ends.append(len(ids))
                if len(ids) >= FLUSH or row + 1 == batch.num_rows:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(ids, np.int32)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, row + 1 - first), lists], names=[key, "ids"])
                    ids, ends, first = [], [0], row + 1

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(key, text).mapInArrow(run, schema)


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The input's other columns with ``n_tokens`` in place of the text."""
    shared = shared_encoder(docs.sparkSession, path)
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in batches:
            n = pa.array([len(encoder.encode(v)) for v in batch.column(len(kept)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], n], names=[*kept, "n_tokens"])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("n_tokens", T.LongType())])
    return docs.select(*kept, F.col(text)).mapInArrow(run, schema)
