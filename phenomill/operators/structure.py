"""Population structure: relatedness, principal components and projection."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.ranks import ordered_prefix, top_n_per_group
from phenomill.operators import alleles, pca
from phenomill.operators.genotypes import VARIANT, allele_frequency
from phenomill.operators.variant_rows import from_long, is_variant_rows, restrict, sample_index
from phenomill.session import broadcast_checked, scratch_path, write_intermediate
from phenomill.sources.blocks import Blocks, write_block

# Number of components; relatedness cut-off and marker count.
N_COMPONENTS = 20
RELATEDNESS_CUTOFF = 0.05
KINSHIP_MARKERS = 5000
PAIRS_PER_TASK = 4
#: Kinships that a task computes in all, and at once.
KINSHIPS_PER_TASK = 1 << 24
KINSHIPS_AT_ONCE = 1 << 18


def polymorphic_index(genotypes: DataFrame) -> DataFrame:
    """Variants with 0 < af < 1: frequency, running number ``idx`` and their count ``m``."""
    af = allele_frequency(genotypes).where((F.col("af") > 0) & (F.col("af") < 1))
    ordered = ordered_prefix(af.withColumn("__all", F.lit(0)), ["__all"], VARIANT)
    return ordered.select(*VARIANT, "af", F.col("__before").cast("int").alias("idx"), F.col("__total").alias("m"))


def _normalized():
    """(g - 2p) / sqrt(2p(1-p) m)"""
    p = F.col("af")
    return (F.col("dosage") - 2 * p) / F.sqrt(F.col("m") * 2 * p * (1 - p))


def _components(genotypes: DataFrame, samples: DataFrame | None, flagged: DataFrame | None, k: int):
    """Components of the samples that aren't flagged, from either form of genotypes; scores of all."""
    if is_variant_rows(genotypes):
        index, variants = samples, genotypes
    else:
        index = write_intermediate(sample_index(genotypes if samples is None else samples), "samples")
        variants = write_intermediate(from_long(genotypes, index), "variant-rows")
    if flagged is None:
        marked, kept = index.withColumn("kept", F.lit(True)), variants
    else:
        out = flagged.select("s").distinct().withColumn("__flagged", F.lit(True))
        marked = index.join(out, "s", "left").select("sample_idx", "s", F.col("__flagged").isNull().alias("kept"))
        marked = write_intermediate(marked, "marked-samples")
        kept, _ = restrict(variants, index, marked.where("kept"))
    return pca.principal_components(variants, allele_frequency(kept), marked, k)


def hwe_normalized_pca(
    genotypes: DataFrame, k: int = N_COMPONENTS, samples: DataFrame | None = None
) -> tuple[list[float], DataFrame, DataFrame]:
    """Eigenvalues, scores (s, scores) and loadings (variant, af, m, loadings).

    Long rows are brought into variant rows first; variant rows need their ``samples`` (sample_idx, s).
    """
    return _components(genotypes, samples, None, k)


def join_loadings_af(loadings: DataFrame, af: DataFrame) -> DataFrame:
    """Loadings with the frequency ``af`` of their alt allele. With alleles on both sides these are matched,
    and the frequency of a swapped variant is turned; else the marker id is."""
    if not (_has_alleles(loadings) and _has_alleles(af)):
        return loadings.join(af, VARIANT, "left")
    joined = alleles.join_alleles(loadings, af, ["af"])
    return joined.withColumn("af", F.when(F.col("swapped"), 1 - F.col("af")).otherwise(F.col("af"))).drop("swapped")


def _has_alleles(df: DataFrame) -> bool:
    return {"ref", "alt"} <= set(df.columns)


def pc_project(genotypes: DataFrame, loadings: DataFrame, k: int = N_COMPONENTS) -> DataFrame:
    """Scores of samples on given loadings; missing calls are skipped, variants need 0 < af < 1.

    ``m`` is the number of usable variants of the loadings; it is counted when not given. Where both sides have alleles a variant
    is found by locus and alleles, and the dosage of a swapped one is turned (2 - g); else by locus and marker id.
    """
    usable = loadings.where((F.col("af") > 0) & (F.col("af") < 1))
    if "m" not in usable.columns:
        usable = usable.withColumn("m", usable.agg(F.count(F.lit(1))).scalar())
    matched = _has_alleles(loadings) and _has_alleles(genotypes)
    values = ["af", "m", *[F.col("loadings")[i].alias(f"l{i}") for i in range(k)]]
    flat = usable.select(*VARIANT, *(["ref", "alt"] if matched else []), *values)
    flat = broadcast_checked(write_intermediate(flat, "loadings"), 120 + 8 * k)
    called = genotypes.where(F.col("dosage").isNotNull())
    if matched:
        rows = alleles.join_alleles(called, flat, ["af", "m", *[f"l{i}" for i in range(k)]], "inner")
        rows = rows.withColumn("dosage", F.when(F.col("swapped"), 2 - F.col("dosage")).otherwise(F.col("dosage")))
    else:
        rows = called.join(flat.drop("ref", "alt"), VARIANT)
    return (
        rows.withColumn("__z", _normalized())
        .groupBy("s")
        .agg(F.array(*[F.sum(F.col("__z") * F.col(f"l{i}")) for i in range(k)]).alias("scores"))
    )


def union_scores(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def population_pcs(
    genotypes: DataFrame, flagged: DataFrame, k: int = N_COMPONENTS, samples: DataFrame | None = None
) -> tuple[list[float], DataFrame, DataFrame]:
    """PCA on unflagged samples, projection of the flagged ones, all scores together.

    Flagged samples have a weight of 0 in every round; the last product, of all samples with the loadings, is the projection.
    """
    return _components(genotypes, samples, flagged, k)


def eigenvalue_table(spark, eigenvalues: list[float]) -> DataFrame:
    return spark.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(eigenvalues)], "PC int, Eigenvalue double"
    )


def random_markers(genotypes: DataFrame, n: int = KINSHIP_MARKERS, seed: int = 1) -> DataFrame:
    """``n`` markers in hash order."""
    variants = genotypes.select("marker_id").distinct().withColumn("__all", F.lit(0))
    order = [F.xxhash64("marker_id", F.lit(seed)), F.col("marker_id")]
    return top_n_per_group(variants, ["__all"], order, n, ["marker_id"]).select("marker_id")


def sparse_relatedness(
    genotypes: DataFrame,
    n_markers: int = KINSHIP_MARKERS,
    cutoff: float = RELATEDNESS_CUTOFF,
    block_size: int = 2048,
    seed: int = 1,
) -> DataFrame:
    """Edges (i, j, kinship) of sample pairs i <= j with kinship of at least ``cutoff``.

    Kinship is the mean over markers of the product of normalized genotypes, missing as 0. No
    bound can rule a pair out beforehand, so all are multiplied, but as matrix products
    of sample blocks. A block of ``block_size`` samples by ``n_markers`` bytes is written once, with its names, as files in the shared
    folder; the work list has a row per block pair, whose task fetches the two. Only the pairs that reach the cut-off leave it,
    under their names, so they are neither stored nor joined, however many they are; reading the result twice multiplies twice.
    """
    chosen = genotypes.join(random_markers(genotypes, n_markers, seed), "marker_id", "left_semi")
    index = write_intermediate(polymorphic_index(chosen), "kinship-variants")
    m = index.count()
    # At most n_markers frequencies.
    frequencies = [r["af"] for r in index.orderBy("idx").select("af").collect()]
    af = np.asarray(frequencies)
    scale = np.sqrt(2 * af * (1 - af))
    rows = (
        chosen.where(F.col("dosage").isNotNull() & F.col("s").isNotNull())
        .join(index.select(*VARIANT, "idx"), VARIANT)
        .groupBy("s")
        .agg(F.collect_list(F.struct("idx", F.col("dosage").cast("tinyint").alias("g"))).alias("gs"))
        .select("s", F.col("gs.idx").alias("idx"), F.col("gs.g").alias("g"))
    )

    def pack(batches):
        for pdf in batches:
            packed = []
            for idx, g in zip(pdf["idx"], pdf["g"]):
                line = np.full(m, -1, dtype="int8")
                line[np.asarray(idx)] = g
                packed.append(line.tobytes())
            yield pd.DataFrame({"s": pdf["s"], "line": packed})

    spark = genotypes.sparkSession
    s_type = dict(genotypes.dtypes)["s"]
    packed = write_intermediate(rows.mapInPandas(pack, f"s {s_type}, line binary"), "packed")
    samples = write_intermediate(sample_index(packed), "kinship-samples")
    n_blocks = -(-samples.count() // block_size)
    folder = scratch_path(spark, "kinship-blocks")
    placed = packed.join(samples, "s").select(F.floor(F.col("sample_idx") / block_size).cast("int").alias("block"), "sample_idx", "s", "line")

    def write(block: int, parts: list[pa.RecordBatch]) -> None:
        whole = pa.Table.from_batches(parts)
        lines = np.frombuffer(b"".join(whole["line"].to_pylist()), dtype="int8")
        write_block(folder, f"s-{block}", lines.reshape(whole.num_rows, m))
        names = pa.BufferOutputStream()
        with pa.ipc.new_stream(names, pa.schema([whole.schema.field("s")])) as out:
            out.write_table(whole.select(["s"]))
        write_block(folder, f"names-{block}", np.frombuffer(names.getvalue(), dtype="uint8"))

    def store(batches):
        block, parts = None, []
        for batch in batches:
            own = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if own[start] != block:
                    if parts:
                        write(block, parts)
                    block, parts = int(own[start]), []
                parts.append(batch.slice(start, end - start))
        if parts:
            write(block, parts)
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int32())], ["block"])

    placed.repartition("block").sortWithinPartitions("block", "sample_idx").mapInArrow(store, "block int").count()

    def normalized(g: np.ndarray) -> np.ndarray:
        z = (g - 2 * af) / scale
        z[g < 0] = 0.0
        return z

    def multiply(batches):
        fetch, left = Blocks(folder, 2), None

        def block(k: int) -> tuple[pa.Array, np.ndarray]:
            names = pa.ipc.open_stream(pa.py_buffer(fetch(f"names-{k}"))).read_all()["s"].combine_chunks()
            return names, normalized(fetch(f"s-{k}"))

        for batch in batches:
            for a, b in zip(batch.column("bi").to_pylist(), batch.column("bj").to_pylist()):
                if left is None or left[0] != a:
                    left = (a, *block(a))
                (left_names, x), (right_names, y) = left[1:], left[1:] if a == b else block(b)
                step = max(1, KINSHIPS_AT_ONCE // len(y))
                for top in range(0, len(x), step):
                    kinship = x[top : top + step] @ y.T / m
                    keep = kinship >= cutoff
                    at = np.flatnonzero(np.triu(keep, top) if a == b else keep)
                    i, j = np.divmod(at, len(y))
                    columns = [left_names.take(pa.array(top + i)), right_names.take(pa.array(j)), pa.array(kinship.ravel()[at])]
                    yield pa.RecordBatch.from_arrays(columns, ["i", "j", "kinship"])

    n_pairs = n_blocks * (n_blocks + 1) // 2
    pairs = spark.range(n_blocks).select(
        F.col("id").cast("int").alias("bi"), F.explode(F.sequence(F.col("id").cast("int"), F.lit(n_blocks - 1))).alias("bj")
    )
    # Small blocks are dealt by the kinships of a task, but not to fewer tasks than run at once.
    tasks = max(-(-n_pairs * block_size**2 // KINSHIPS_PER_TASK), min(-(-n_pairs // PAIRS_PER_TASK), spark.sparkContext.defaultParallelism))
    work = pairs.repartitionByRange(max(1, tasks), "bi", "bj").sortWithinPartitions("bi", "bj")
    # Samples are numbered in the order of their names, so i <= j.
    return work.mapInArrow(multiply, f"i {s_type}, j {s_type}, kinship double")
