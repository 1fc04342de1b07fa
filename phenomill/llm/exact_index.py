"""Exact deduplication over a cuckoo-filter index of live digests.

Texts are equal when they are identical after lower-casing A-Z. Their SHA-256 is the key. Keys are
dealt out by hash; each task holds the index of its share: a cuckoo filter over short fingerprints in
front of bucketed content (the full keys with their live document). A miss of the filter proves a key
new; a hit is verified against the content. A filter that is full is built anew, twice as large,
from the stored keys.

Tasks first sum up their own rows, so that a group of copies of any size arrives as at most one row
per task. Result: one row per input row. Null texts count as empty; rows without an id count in their
group but never stay; of several rows with the id that stays, all are marked kept. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import slices, texts, written

KEY_SCHEMA = "digest binary, keep_id long, group_size long"
KEYS_HELD = 200_000


class CuckooIndex:
    """Keys with a live document and a count; supports insertion, deletion and growth."""

    SLOTS = 4
    MAX_KICKS = 200

    def __init__(self, buckets: int = 1024):
        self.content: dict[int, dict[bytes, list]] = {}
        self.size = 0
        self.grown = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.table = np.zeros((buckets, self.SLOTS), dtype=np.uint16)

    @staticmethod
    def _parts(key: bytes) -> tuple[int, int]:
        return int.from_bytes(key[:8], "little"), int.from_bytes(key[8:10], "little") or 1

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def may_contain(self, key: bytes) -> bool:
        h, mark = self._parts(key)
        first = h & self.mask
        return mark in self.table[first] or mark in self.table[self._other(first, mark)]

    def get(self, key: bytes) -> list | None:
        """The entry of a key: [live document, count]. Filter first, then the bucketed content."""
        if not self.may_contain(key):
            return None
        return self.content.get(self._parts(key)[0] & 0xFFFF, {}).get(key)

    def _place(self, key: bytes) -> bool:
        h, mark = self._parts(key)
        bucket = h & self.mask
        for kick in range(self.MAX_KICKS):
            for b in (bucket, self._other(bucket, mark)):
                free = np.flatnonzero(self.table[b] == 0)
                if len(free):
                    self.table[b, free[0]] = mark
                    return True
            slot = kick % self.SLOTS
            bucket = self._other(bucket, mark)
            self.table[bucket, slot], mark = mark, int(self.table[bucket, slot])
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.grown += 1
            self._clear(buckets)
            if all(self._place(key) for held in self.content.values() for key in held):
                return

    def insert(self, key: bytes, live, count: int = 1) -> None:
        self.content.setdefault(self._parts(key)[0] & 0xFFFF, {})[key] = [live, count]
        self.size += 1
        if self.size > 0.9 * self.SLOTS * (self.mask + 1) or not self._place(key):
            self._grow()

    def delete(self, key: bytes) -> bool:
        if self.get(key) is None:
            return False
        h, mark = self._parts(key)
        first = h & self.mask
        for b in (first, self._other(first, mark)):
            found = np.flatnonzero(self.table[b] == mark)
            if len(found):
                self.table[b, found[0]] = 0
                break
        del self.content[h & 0xFFFF][key]
        self.size -= 1
        return True

    def add(self, key: bytes, doc_id, count: int) -> None:
        """Count a key in; a larger document takes the place of the live one."""
        entry = self.get(key)
        if entry is None:
            self.insert(key, doc_id, count)
            return
        live, seen = entry
        if doc_id is not None and (live is None or doc_id > live):
            self.delete(key)
            self.insert(key, doc_id, seen + count)
        else:
            entry[1] = seen + count

    def rows(self) -> Iterator[tuple]:
        return ((key, live, count) for held in self.content.values() for key, (live, count) in held.items())


def normalised(text: bytes) -> bytes:
    """A-Z in lower case; ``bytes.lower`` leaves all other letters as they are."""
    return text.lower()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1000):
        keys = [hashlib.sha256(normalised(t)).digest() for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary())], ["doc_id", "digest"])


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the normalised text."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_digests, "doc_id long, digest binary")


def _key_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = list(rows)
    for at in range(0, len(held), 50_000):
        part = held[at : at + 50_000]
        columns = zip(*part)
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, (pa.binary(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["digest", "keep_id", "group_size"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task by key; the table is passed on whenever it is full."""
    held: dict[bytes, list] = {}
    for batch in batches:
        for doc_id, key in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist()):
            entry = held.get(key)
            if entry is None:
                held[key] = [doc_id, 1]
            else:
                entry[1] += 1
                if doc_id is not None and (entry[0] is None or doc_id > entry[0]):
                    entry[0] = doc_id
        if len(held) > KEYS_HELD:
            yield from _key_batches((k, *v) for k, v in held.items())
            held = {}
    yield from _key_batches((k, *v) for k, v in held.items())


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for key, doc_id, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
            index.add(key, doc_id, count)
    yield from _key_batches(index.rows())


def build_index(rows: DataFrame) -> DataFrame:
    """Live keys (digest, keep_id, group_size) of (doc_id, digest) rows."""
    return rows.mapInArrow(_summed, KEY_SCHEMA).repartition("digest").mapInArrow(_indexed, KEY_SCHEMA)


def _changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, gone = CuckooIndex(), []
    for batch in batches:
        for key, doc_id, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if count < 0:
                gone.append(key)
            else:
                index.add(key, doc_id, count)
    for key in gone:
        index.delete(key)
    yield from _key_batches(index.rows())


def update_index(index: DataFrame, added: DataFrame | None = None, withdrawn: DataFrame | None = None) -> DataFrame:
    """The index after inserting ``added`` (doc_id, digest) rows and then deleting ``withdrawn`` digests.

    Keys that are not in the index are withdrawn without effect.
    """
    rows = index.select("digest", "keep_id", "group_size")
    if added is not None:
        rows = rows.unionByName(added.select("doc_id", "digest").mapInArrow(_summed, KEY_SCHEMA))
    if withdrawn is not None:
        rows = rows.unionByName(withdrawn.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(-1).cast("long").alias("group_size")).distinct())
    return rows.repartition("digest").mapInArrow(_changed, KEY_SCHEMA)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(digests(docs, doc_id, text), "digests")
    return rows.join(build_index(rows), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts: that with the largest id, any one of several such rows; a row without an id
    stays only if no equal text has one.

    Ids of which no row stays are left out by id, so texts aren't shuffled by their digest; only rows of an id that also
    has a row that stays (repeated ids, rows without an id) are told apart by their text.
    """
    rows = written(digests(docs, doc_id, text), "digests")
    index = written(build_index(rows), "exact-index")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    by_id = rows.join(index, "digest").groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(stays).alias("kept"))
    by_id = written(by_id.where("n > 1 OR kept = 0"), "exact-by-id")
    same_id = lambda ids: docs[doc_id].cast("long").eqNullSafe(ids["doc_id"])
    rest = docs.join(by_id, same_id(by_id), "left_anti")
    mixed = by_id.where("kept > 0")
    some = docs.join(mixed, same_id(mixed), "left_semi")
    keyed = some.withColumns({"__digest": _digest_column(text), "__id": F.col(doc_id).cast("long")})
    winners = index.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"))
    chosen = keyed.join(winners, "__digest").where(F.col("__id").eqNullSafe(F.col("__keep"))).dropDuplicates(["__digest"])
    return rest.unionByName(chosen.select(*docs.columns))


def _digest_column(text: str):
    """The digest of ``digests`` as an expression."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.unhex(F.sha2(lower.cast("binary"), 256))
