"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary resolves whole pre-tokens. Keys are placed level by
level: on each level a key takes the slot of its hash unless another key wants it too; keys that collide go
on to the next level. The number of taken slots before a key's slot is its place, so n keys use exactly the places
0 to n-1. A pre-token that isn't in the vocabulary also gets a place; comparing bytes tells it apart.
Tier 2: the bytes of a miss form a linked list; a heap holds the ranks of adjacent pairs, lowest rank first,
then leftmost, until no pair has a rank.

The vocabulary (some 50,000 entries of a fixed file) is read from its path on each worker, where the hash
is built once. Null texts count as empty, texts without tokens give no ids; each input row gives one
row, repeated ids and rows without an id too; other columns are ignored. Every pre-token is
encoded on its own and costs n log n, whatever its length.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import mix, slices

CACHED = 300_000
LONGEST_CACHED = 64


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings: key -> place in 0..n-1."""

    SPARE = 2.0

    def __init__(self, keys: list[bytes]):
        hashes = self._hash(keys)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("keys are not distinct")
        self.taken: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        placed, left = 0, hashes
        while len(left):
            slots = max(8, int(len(left) * self.SPARE))
            at = self._slot(left, len(self.taken), slots)
            alone = np.bincount(at, minlength=slots) == 1
            self.taken.append(alone)
            self.before.append(placed + np.cumsum(alone) - alone)
            placed += int(alone.sum())
            left = left[~alone[at]]
        order = self._place(hashes)
        self.keys: list[bytes] = [b""] * len(keys)
        self.position = np.empty(len(keys), dtype=np.int64)
        for i, place in enumerate(order.tolist()):
            self.keys[place] = keys[i]
            self.position[place] = i

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))

    @staticmethod
    def _slot(hashes: np.ndarray, level: int, slots: int) -> np.ndarray:
        return (mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(slots)).astype(np.int64)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        place = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for level, (taken, before) in enumerate(zip(self.taken, self.before)):
            at = self._slot(hashes[left], level, len(taken))
            hit = taken[at]
            place[left[hit]] = before[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return place

    def find(self, keys: list[bytes]) -> list[int]:
        """Number of each key in the list the hash was built from, -1 for a stranger."""
        places = self._place(self._hash(keys)).tolist()
        own, position = self.keys, self.position
        return [int(position[p]) if p >= 0 and own[p] == k else -1 for k, p in zip(keys, places)]


class Codec:
    """Encoder and decoder of one vocabulary: byte strings with ranks, which are also the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.ids = list(ranks.values())
        self.hash = PerfectHash(list(ranks))
        self.bytes_of: list[bytes] = [b""] * (max(self.ids, default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.decimal = list(map(str, range(len(self.bytes_of))))
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        # Pairs of ids whose joint bytes are a token: the heap then never touches bytes.
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = rank
        self.cache: dict[str, tuple[str, int]] = {}

    def merge(self, token: bytes) -> list[int]:
        """Tier 2: the merges of one pre-token."""
        byte_ids, pairs = self.byte_ids, self.pairs
        ids = [byte_ids[b] for b in token]
        n = len(ids)
        heap = []
        for i in range(n - 1):
            rank = pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                heap.append(rank << 40 | i)
        if not heap:
            return ids
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 40, top & 0xFFFFFFFFFF
            left = ids[i]
            j = after[i]
            if left < 0 or j >= n or pairs.get(left << 32 | ids[j]) != rank:
                continue  # one of the two has changed since
            ids[i], ids[j] = rank, -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                new = pairs.get(rank << 32 | ids[j])
                if new is not None:
                    heapq.heappush(heap, new << 40 | i)
            k = before[i]
            if k >= 0:
                new = pairs.get(ids[k] << 32 | rank)
                if new is not None:
                    heapq.heappush(heap, new << 40 | k)
        return [x for x in ids if x >= 0]

    def resolve(self, tokens: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct pre-tokens: perfect hash first, heap for the misses."""
        raw = [t.encode() for t in tokens]
        ids = self.ids
        return {
            t: (ids[found],) if found >= 0 else tuple(self.merge(b)) for t, b, found in zip(tokens, raw, self.hash.find(raw))
        }

    def encode_all(self, documents: list[str]) -> Iterator[list[tuple[int, ...]]]:
        """For each text the ids of its pre-tokens in order."""
        cache = self.cache
        for text in documents:
            parts = self.split(text)
            new = [t for t in set(parts) if t not in cache]
            if new:
                cache.update(self.resolve(new))
            yield [cache[t] for t in parts]
            if len(cache) > CACHED:
                cache.clear()
            elif new:
                for t in new:
                    if len(t) > LONGEST_CACHED:
                        del cache[t]

    def encode(self, text: str) -> list[int]:
        return [i for ids in next(self.encode_all([text])) for i in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of base64 bytes and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file."""
    return Codec(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = [np.fromiter((i for ids in parts for i in ids), dtype=np.int32) for parts in c.encode_all([t or "" for t in part.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _narrow(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, data): the bytes of each row's ids; null ids give no bytes. Unknown ids are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            out = [c.decode(x or ()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "data"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row: encodes, then decodes the ids, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in slices(batches):
            count, ids_digest, text_digest = [], [], []
            for parts in c.encode_all([t or "" for t in batch.column("text").to_pylist()]):
                ids = list(itertools.chain.from_iterable(parts))
                count.append(len(ids))
                ids_digest.append(hashlib.sha256(" ".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                text_digest.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _narrow(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
