"""Summaries of bounded size over all rows: counts by hash bucket, and bitmaps.

Their size has a bound set by a parameter, so they may be sent to every task. They are summed up
in pieces across tasks; only the finished summary comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phenomill.llm.common import mix, slices

PIECE_BITS = 14
PIECE = "piece int, data binary"


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def bits_for(n: int, most: int) -> int:
    """Bits of an index into a bitmap for ``n`` hashes: at least 8 places for each, at most 2^``most`` in all."""
    return min(most, max(16, (8 * n).bit_length()))


class Counts:
    """Counts of one task, given out as pieces of 2^PIECE_BITS buckets."""

    AT_ONCE = 1 << 20

    def __init__(self, bits: int):
        self.bits, self.total = bits, np.zeros(1 << bits, dtype=np.uint32)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, hashes: np.ndarray) -> None:
        self.waiting.append(hashes)
        self.size += len(hashes)
        if self.size > self.AT_ONCE:
            self.flush()

    def flush(self) -> None:
        if self.size:
            at = bucket(np.concatenate(self.waiting), self.bits)
            self.total += np.bincount(at, minlength=len(self.total)).astype(np.uint32)
        self.waiting, self.size = [], 0

    def pieces(self) -> Iterator[tuple[int, bytes]]:
        self.flush()
        width = 1 << min(PIECE_BITS, self.bits)
        for number in range(len(self.total) // width):
            part = self.total[number * width : (number + 1) * width]
            if part.any():
                yield number, part.tobytes()


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(data, dtype=np.uint32)
            held[number] = held[number] + part if number in held else part.astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["piece", "data"])


def total_counts(pieces: DataFrame, bits: int) -> np.ndarray:
    """The 2^bits counts of all tasks from their pieces (piece, data)."""
    width = 1 << min(PIECE_BITS, bits)
    out = np.zeros(1 << bits, dtype=np.uint64)
    for row in pieces.repartition("piece").mapInArrow(_sum, PIECE).collect():
        out[row.piece * width : (row.piece + 1) * width] = np.frombuffer(row.data, dtype=np.uint64)
    return out


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """2^bits booleans as packed bytes: set for the bucket of every hash in the one long column of ``hashes``."""
    span = 1 << min(20, bits)

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(bucket(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // span).astype(np.int32)), pa.array((at % span).astype(np.int32))], ["piece", "at"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number in np.unique(piece).tolist():
                held.setdefault(number, np.zeros(span, dtype=bool))[at[piece == number]] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([np.packbits(v).tobytes() for v in held.values()], pa.binary())], ["piece", "data"])

    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    rows = hashes.mapInArrow(positions, "piece int, at int").distinct().repartition("piece").mapInArrow(packed, PIECE)
    for row in rows.collect():
        out[row.piece * span // 8 : (row.piece + 1) * span // 8] = np.frombuffer(row.data, dtype=np.uint8)
    return out


def in_bitmap(hashes: np.ndarray, bits: int, data: np.ndarray) -> np.ndarray:
    at = bucket(hashes, bits)
    return (data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def split_by(df: DataFrame, column: str, keys: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """(likely, never): rows whose long ``column`` may be among ``keys`` (one long column), and rows whose isn't.

    A bitmap of fixed size sorts them before a join has to shuffle them. All rows with a key are likely; how many
    others are depends on how full the bitmap is. The join itself still follows. Nulls are never among the keys.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_mixed(batch.column(0)).view(np.int64))], ["h"])

    wanted = bitmap(keys.mapInArrow(hashed, "h long"), bits)

    def chosen(likely: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1000):
                values = batch.column(column)
                found = in_bitmap(_mixed(values.fill_null(0)), bits, wanted) & values.is_valid().to_numpy(zero_copy_only=False)
                keep = found if likely else ~found
                if keep.any():
                    yield batch.filter(pa.array(keep))

        return df.mapInArrow(run, df.schema)

    return chosen(True), chosen(False)


def only_in(df: DataFrame, column: str, keys: DataFrame, bits: int) -> DataFrame:
    """The likely rows of ``split_by``."""
    return split_by(df, column, keys, bits)[0]


def _mixed(column: pa.Array) -> np.ndarray:
    return mix(column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
