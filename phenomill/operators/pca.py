"""Principal components of variant rows by blocked subspace iteration.

Genotypes are cut into tiles of ``VARIANTS`` by ``SAMPLES`` calls, each a file in the shared folder. A round multiplies every tile
twice: by the current directions of its samples, summed up per block of variants, and by these sums, summed up per block of samples.
Tasks get rows (variant block, sample block) and fetch the blocks they need; only partial sums are shuffled. The driver
sees products of ``width`` by ``width`` numbers, by which directions are made orthogonal and rotated to the eigenvectors of
their span. Nothing with a length of the variants or the samples is in one row, one task or the driver.

Where ``width`` directions span everything the first round is exact; else rounds go on until the wanted eigenvalues
stand still.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.ranks import ordered_prefix
from phenomill.operators.variant_rows import variant_key
from phenomill.session import broadcast_checked, scratch_path, write_intermediate
from phenomill.sources.blocks import Blocks, write_block

VARIANTS, SAMPLES = 512, 1024
WIDTH = 64
TILES_PER_TASK = 64
ROUNDS = 200
STILL = 1e-10
RANK = 1e-12

_PART = "block int, part binary"


def _number_variants(frequency: DataFrame) -> DataFrame:
    """Polymorphic variants with their block, place in it, and the number m of all."""
    key = variant_key(frequency)
    chosen = frequency.where((F.col("af") > 0) & (F.col("af") < 1)).withColumn("__all", F.lit(0))
    ordered = ordered_prefix(chosen, ["__all"], key)
    number = F.col("__before")
    return ordered.select(
        *key, "af", F.col("__total").alias("m"), F.floor(number / VARIANTS).cast("int").alias("vblock"), (number % VARIANTS).cast("int").alias("at")
    )


class Tiles:
    """Calls by variant and sample block; a product takes them normalized, (g - 2p) / sqrt(2p(1 - p) m), missing as 0."""

    def __init__(self, variants: DataFrame, index: DataFrame, n: int, label: str = "tiles"):
        """``index``: written output of ``_number_variants``; the dosage arrays have ``n`` elements."""
        self.folder = scratch_path(variants.sparkSession, label)
        self.n, self.sample_blocks = n, -(-n // SAMPLES)
        folder, key = self.folder, variant_key(index)
        pieces = F.transform(F.sequence(F.lit(0), F.lit(self.sample_blocks - 1)), lambda i: F.slice("dosages", i * SAMPLES + 1, SAMPLES))
        rows = (
            variants.select(*key, F.col("dosages").cast("array<float>").alias("dosages"))
            .join(broadcast_checked(index, 120), key)
            .select("vblock", "at", "af", "m", F.posexplode(pieces).alias("sblock", "g"))
        )
        dealt = rows.repartition("vblock", "sblock").sortWithinPartitions("vblock", "sblock", "at")

        def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, lines, scale = None, [], []

            def out() -> pa.RecordBatch:
                write_block(folder, f"g-{key[0]}-{key[1]}", np.stack(lines))
                if key[1] == 0:
                    write_block(folder, f"p-{key[0]}", np.array(scale))
                return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32())], ["vblock", "sblock"])

            for batch in batches:
                names = zip(batch.column("vblock").to_pylist(), batch.column("sblock").to_pylist())
                p, m = batch.column("af").to_numpy(), batch.column("m").to_numpy()
                for row, name in enumerate(names):
                    if name != key:
                        if lines:
                            yield out()
                        key, lines, scale = name, [], []
                    lines.append(batch.column("g")[row].values.to_numpy(zero_copy_only=False))
                    scale.append((2 * p[row], np.sqrt(2 * p[row] * (1 - p[row]) * m[row])))
            if lines:
                yield out()

        self.work = write_intermediate(dealt.mapInArrow(store, "vblock int, sblock int"), label)
        tiles = self.work.count()
        self.tasks = max(1, -(-tiles // TILES_PER_TASK))

    def _partial(self, by: str, other: str, inputs: str, turn: np.ndarray, transposed: bool) -> DataFrame:
        """Products of the tiles with the ``inputs`` blocks times ``turn``, added up per block of ``by`` within a task."""
        folder = self.folder
        work = self.work.repartitionByRange(self.tasks, by, other).sortWithinPartitions(by, other).select(by, other)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fetch = Blocks(folder, 16)
            block, total = None, None

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "part"])

            for batch in batches:
                for mine, their in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if mine != block:
                        if total is not None:
                            yield out()
                        block, total = mine, None
                    vblock, sblock = (their, mine) if transposed else (mine, their)
                    shift = fetch(f"p-{vblock}")
                    z = np.nan_to_num((fetch(f"g-{vblock}-{sblock}") - shift[:, :1]) / shift[:, 1:])
                    product = (z.T if transposed else z) @ (fetch(f"{inputs}-{their}") @ turn)
                    total = product if total is None else total + product
            if total is not None:
                yield out()

        return work.mapInArrow(run, _PART)

    def _summed(self, parts: DataFrame, blocks: int, width: int, name: str, mask: str | None = None) -> np.ndarray:
        """Writes the sums of the parts as blocks ``name`` and returns their Gram matrix and column sums (last row)."""
        folder = self.folder

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram = np.zeros((width + 1, width))
            block, total = None, None

            def close() -> None:
                nonlocal total
                if mask is not None:
                    total = total * Blocks(folder, 1)(f"{mask}-{block}")[:, None]
                write_block(folder, f"{name}-{block}", total)
                gram[:width] += total.T @ total
                gram[width] += total.sum(axis=0)

            for batch in batches:
                for row in range(batch.num_rows):
                    key = batch.column(0)[row].as_py()
                    part = np.frombuffer(batch.column(1)[row].as_py()).reshape(-1, width)
                    if key != block:
                        if total is not None:
                            close()
                        block, total = key, None
                    total = part.copy() if total is None else total + part
            if total is not None:
                close()
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([gram.tobytes()], pa.binary())], ["block", "part"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram = np.zeros((width + 1, width))
            for batch in batches:
                for part in batch.column(1).to_pylist():
                    gram += np.frombuffer(part).reshape(width + 1, width)
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([gram.tobytes()], pa.binary())], ["block", "part"])

        dealt = parts.repartition(max(1, min(blocks, self.tasks)), "block").sortWithinPartitions("block")
        grams = dealt.mapInArrow(run, _PART).coalesce(16).mapInArrow(add, _PART).collect()  # at most 16 small matrices
        return sum(np.frombuffer(r.part).reshape(width + 1, width) for r in grams)

    def to_variants(self, inputs: str, turn: np.ndarray, name: str) -> np.ndarray:
        parts = self._partial("vblock", "sblock", inputs, turn, False)
        return self._summed(parts, self.tasks, turn.shape[1], name)

    def to_samples(self, inputs: str, turn: np.ndarray, name: str, mask: str | None = None) -> np.ndarray:
        parts = self._partial("sblock", "vblock", inputs, turn, True)
        return self._summed(parts, self.sample_blocks, turn.shape[1], name, mask)

    def start(self, width: int, samples: DataFrame, name: str, mask: str) -> None:
        """Random directions over the samples with ``kept``, the same on every run, and the mask of the others."""
        folder, n, size = self.folder, self.n, SAMPLES
        at = F.col("sample_idx") % SAMPLES
        rows = samples.groupBy(F.floor(F.col("sample_idx") / SAMPLES).cast("int").alias("sblock")).agg(
            F.collect_list(F.when(F.col("kept"), at)).alias("kept")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, kept in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    keep = np.zeros(min(size, n - block * size))
                    keep[kept] = 1
                    write_block(folder, f"{mask}-{block}", keep)
                    write_block(folder, f"{name}-{block}", np.random.default_rng([7, block]).standard_normal((len(keep), width)) * keep[:, None])
                yield pa.RecordBatch.from_arrays([batch.column(0)], ["sblock"])

        rows.mapInArrow(run, "sblock int").count()

    def rows(self, name: str, blocks: DataFrame, column: str, turn: np.ndarray) -> DataFrame:
        """(block, at, ``column``): the rows of the blocks ``name`` times ``turn``; ``blocks`` has their numbers."""
        folder = self.folder

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column(0).to_pylist():
                    data = Blocks(folder, 1)(f"{name}-{block}") @ turn
                    columns = [pa.array(np.full(len(data), block, np.int32)), pa.array(np.arange(len(data), dtype=np.int32)), pa.array(list(data))]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "at", column])

        return blocks.mapInArrow(run, f"block int, at int, {column} array<double>")


def _orthogonal(gram: np.ndarray) -> np.ndarray:
    """T such that X T has orthonormal columns, for X with this Gram matrix; directions without extent go."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(values.max(initial=0.0), 0.0) * RANK
    return vectors[:, keep] / np.sqrt(values[keep])


def principal_components(
    variants: DataFrame, frequency: DataFrame, samples: DataFrame, k: int
) -> tuple[list[float], DataFrame, DataFrame]:
    """Eigenvalues, scores (s, scores) of all samples and loadings (variant, af, m, loadings).

    ``variants`` are variant rows over all of ``samples`` (sample_idx, s, kept); components come from the kept ones, with their ``frequency``
    (variant, af). Of the two signs of a component the one is taken whose loadings have a positive sum.
    """
    index = write_intermediate(_number_variants(frequency), "variants")
    m = index.count()
    if m == 0:
        raise ValueError("no polymorphic variant")
    counts = samples.agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).first()
    key = variant_key(index)
    tiles = Tiles(variants, index, counts.n)
    most = min(m, counts.kept)
    width = min(most, max(2 * k, WIDTH))
    tiles.start(width, samples, "q0", "mask")
    turn, before = np.eye(width), None
    for number in range(ROUNDS):
        gram = tiles.to_variants(f"q{number}", turn, f"w{number}")
        size = gram.shape[1]
        sums, gram = gram[size], gram[:size]
        if number:
            # The directions were orthonormal: the eigenvectors of their span, the largest first.
            values, vectors = np.linalg.eigh(gram)
            values, vectors = values[::-1], vectors[:, ::-1]
            keep = values > values[0] * RANK
            values, vectors = values[keep], vectors[:, keep]
            best = values[: min(k, len(values))]
            done = width == most or (before is not None and len(before) == len(best) and np.all(np.abs(best - before) <= STILL * best[0]))
            if done or number == ROUNDS - 1:
                break
            before, outward = best, vectors / values
        else:
            outward = _orthogonal(gram)
        gram = tiles.to_samples(f"w{number}", outward, f"q{number + 1}", "mask")
        turn = _orthogonal(gram[: gram.shape[1]])
    loading = vectors[:, : len(best)] / np.sqrt(best)
    loading = loading * np.where(sums @ loading < 0, -1.0, 1.0)
    tiles.to_samples(f"w{number}", loading, "scores")
    vblocks = tiles.work.select("vblock").distinct()
    sblocks = tiles.work.select("sblock").distinct()
    weights = tiles.rows(f"w{number}", vblocks, "loadings", loading).withColumnRenamed("block", "vblock")
    loadings = write_intermediate(index.join(weights, ["vblock", "at"]).select(*key, "af", "m", "loadings"), "loadings")
    place = (F.col("block") * SAMPLES + F.col("at")).alias("sample_idx")
    scored = tiles.rows("scores", sblocks, "scores", np.eye(len(best))).select(place, "scores")
    return best.tolist(), scored.join(samples, "sample_idx").select("s", "scores"), loadings
