"""Tables, Arrow batches and word hashes that the operators of this folder share.

Words are the runs between ASCII white space (space, tab to carriage return); ``bytes.split`` cuts
exactly there. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from phenomill.session import write_intermediate

written = write_intermediate

_PRIME = np.uint64(0x100000001B3)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_powers = np.ones(1, dtype=np.uint64)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def discard(df: DataFrame) -> None:
    """Delete a table that ``written`` returned, once nothing reads it any more."""
    files = df.inputFiles()
    if files:
        jvm = df.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that only so many texts are taken out of Arrow at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's signed longs, bit by bit."""
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """1, p, p^2, ... modulo 2^64; kept and extended as longer words come along."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64), _PRIME, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which words begin and end."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes, spans: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """One hash per word, in order."""
    starts, ends = spans or word_spans(data)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    at = place + np.repeat(starts, lengths)
    value = np.frombuffer(data, dtype=np.uint8)[at].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(value * powers(int(lengths.max()))[place], first)
    return mix(sums + lengths.astype(np.uint64) * _MIX_B)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of the whole sequence if it is shorter; none without words."""
    n = len(words)
    if not n:
        return words
    span = min(size, n)
    total = np.zeros(n - span + 1, dtype=np.uint64)
    for j in range(span):
        total = total * _PRIME + words[j : n - span + 1 + j]
    return mix(total + np.uint64(span))


def rolling_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """As shingle_hashes for long runs, by differences of prefix sums instead of ``size`` passes; needs ``size`` words."""
    n = len(words)
    if n < size:
        return np.empty(0, dtype=np.uint64)
    # sum of w[i] * p^i over a window, brought to the same power by p^(-start)
    total = np.concatenate(([np.uint64(0)], np.cumsum(words * powers(n))))
    inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
    back = np.full(n - size + 1, inverse, dtype=np.uint64)
    back[0] = 1
    return mix((total[size:] - total[:-size]) * np.multiply.accumulate(back) + np.uint64(size))


def regroup(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Re-cut batches that arrive sorted by ``key``, so that no key is cut; a table may hold many keys."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if rest and rest[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)
