"""Variant statistics, quality filters, linkage pruning and marker sampling.

Genotypes are long rows ``chrom, pos, marker_id, s, dosage`` (0, 1, 2 alternate alleles, NULL when
missing) or variant rows with a dosage array (``variant_rows``). Statistics of variant rows are narrow;
those of long rows are sums over samples, built from partial sums of bounded tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.functions.ranks import ordered_prefix, top_n_per_group
from phenomill.functions.stats import hwe_exact_p
from phenomill.operators.variant_rows import VARIANT, called, copies, having, is_variant_rows, restrict, sample_index, variant_key
from phenomill.session import broadcast_checked, scratch_path, write_intermediate
from phenomill.sources.blocks import Blocks, write_block

# Thresholds of the array quality filter and of linkage pruning.
MIN_MAF = 0.01
MIN_HWE_P = 1e-50
LD_WINDOW = 50
LD_R2 = 0.05
LD_KB_R2 = 0.1
MARKERS_PER_CLASS = 2000
#: Variants by samples of a stored tile of calls (2 MB), and how many pairs of tiles a task multiplies.
LD_TILE = (512, 4096)
TILE_PAIRS_PER_TASK = 8
TILE = ["chrom", "block", "sblock"]


def allele_frequency(genotypes: DataFrame) -> DataFrame:
    key = variant_key(genotypes)
    if is_variant_rows(genotypes):
        return genotypes.select(*key, F.try_divide(copies(), 2.0 * called()).alias("af"))
    return genotypes.groupBy(*key).agg((F.avg("dosage") / 2).alias("af"))


def allele_counts(genotypes: DataFrame) -> DataFrame:
    """Alternate and reference allele counts; ``c1`` is the minor allele's count, ``c2`` the other's."""
    key = variant_key(genotypes)
    if is_variant_rows(genotypes):
        sums = genotypes.select(*key, copies().cast("bigint").alias("alt_count"), called().cast("bigint").alias("calls"))
    else:
        alt = F.coalesce(F.sum("dosage"), F.lit(0)).cast("bigint")
        sums = genotypes.groupBy(*key).agg(alt.alias("alt_count"), F.count("dosage").alias("calls"))
    alt, ref = F.col("alt_count"), 2 * F.col("calls") - F.col("alt_count")
    return sums.select(*key, "alt_count", ref.alias("ref_count"), F.least(alt, ref).alias("c1"), F.greatest(alt, ref).alias("c2"))


def genotype_counts(genotypes: DataFrame) -> DataFrame:
    key = variant_key(genotypes)
    if is_variant_rows(genotypes):
        return genotypes.select(
            *key,
            having(0).alias("hom_ref"),
            having(1).alias("het"),
            having(2).alias("hom_alt"),
            (F.size("dosages") - called()).cast("bigint").alias("missing"),
        )
    return genotypes.groupBy(*key).agg(
        F.count_if(F.col("dosage") == 0).alias("hom_ref"),
        F.count_if(F.col("dosage") == 1).alias("het"),
        F.count_if(F.col("dosage") == 2).alias("hom_alt"),
        F.count_if(F.col("dosage").isNull()).alias("missing"),
    )


def with_maf(counts: DataFrame) -> DataFrame:
    called = F.col("hom_ref") + F.col("het") + F.col("hom_alt")
    alt = F.try_divide(F.col("het") + 2 * F.col("hom_alt"), 2 * called)
    return counts.withColumn("maf", F.least(alt, 1 - alt))


def variant_qc(
    genotypes: DataFrame,
    samples: DataFrame | None = None,
    chromosomes: list | None = None,
    min_maf: float | None = MIN_MAF,
    min_hwe_p: float | None = MIN_HWE_P,
    index: DataFrame | None = None,
) -> DataFrame:
    """Variants passing the frequency and Hardy-Weinberg filters among the kept samples.

    The exact test runs on three counts per variant, after the cheap filters. Variant rows need their ``index`` (sample_idx,
    s) to keep some of the samples.
    """
    if chromosomes is not None:
        genotypes = genotypes.where(F.col("chrom").isin(chromosomes))
    if samples is not None and is_variant_rows(genotypes):
        genotypes, _ = restrict(genotypes, index, samples)
    elif samples is not None:
        genotypes = genotypes.join(samples.select("s"), "s", "left_semi")
    counts = with_maf(genotype_counts(genotypes))
    if min_maf is not None:
        counts = counts.where(F.col("maf") >= min_maf)
    if min_hwe_p is not None:
        counts = counts.withColumn("hwe_p", hwe_exact_p("hom_ref", "het", "hom_alt")).where(
            F.col("hwe_p") >= min_hwe_p
        )
    return counts


def mac_class(counts: DataFrame, by_minor_count: bool = False) -> DataFrame:
    """``rare`` for 10 to 19 copies, ``common`` from 20 copies of both alleles.

    The established rule also tests ``c2 - c1`` although ``c2`` is already the other allele's
    count; ``by_minor_count`` tests the minor allele's count alone.
    """
    c1, other = F.col("c1"), F.col("c2") - F.col("c1")
    if by_minor_count:
        rare, common = c1.between(10, 19), c1 >= 20
    else:
        rare = other.between(10, 19) | c1.between(10, 19)
        common = (c1 >= 20) & (other >= 20)
    return counts.withColumn("mac_class", F.when(rare, "rare").when(common, "common")).where(
        F.col("mac_class").isNotNull()
    )


def sample_per_class(df: DataFrame, n: int = MARKERS_PER_CLASS, order: list | None = None, seed: int = 1) -> DataFrame:
    """``n`` markers of each class in a hash order, the same on every run."""
    order = order or [F.xxhash64("marker_id", F.lit(seed)), F.col("marker_id")]
    return top_n_per_group(df, ["mac_class"], order, n, ["marker_id"])


def assert_min_rows(df: DataFrame, key: str, required: dict[str, int]) -> DataFrame:
    """Fail when a class has fewer rows than required; returns ``df``."""
    found = {
        r[key]: r["n"]
        for r in df.where(F.col(key).isin(list(required))).groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    short = {k: found.get(k, 0) for k, least in required.items() if found.get(k, 0) < least}
    if short:
        raise ValueError(f"too few rows per {key}: found {short}, required {required}")
    return df


# --- linkage ----------------------------------------------------------------------------


def variant_index(variants: DataFrame) -> DataFrame:
    """Position of each variant in the order of its chromosome, from 0."""
    return ordered_prefix(variants.select(*VARIANT).distinct(), ["chrom"], ["pos", "marker_id"]).select(
        *VARIANT, F.col("__before").cast("bigint").alias("idx")
    )


def ld_pairs(indexed: DataFrame, window: int = LD_WINDOW) -> DataFrame:
    """Variant pairs of one chromosome fewer than ``window`` variants apart.

    Buckets of ``window`` variants turn the range condition into an equi-join: each variant meets
    its own and the next bucket, at most ``2 * window`` rows.
    """
    bucket = F.floor(F.col("idx") / window)
    left = indexed.select(
        "chrom",
        F.col("idx").alias("i"),
        F.col("marker_id").alias("marker_i"),
        F.explode(F.array(bucket, bucket + 1)).alias("bucket"),
    )
    right = indexed.select(
        "chrom", F.col("idx").alias("j"), F.col("marker_id").alias("marker_j"), bucket.alias("bucket")
    )
    return (
        left.join(right, ["chrom", "bucket"])
        .where((F.col("j") > F.col("i")) & (F.col("j") - F.col("i") < window))
        .drop("bucket")
    )


def ld_pairs_kb(indexed: DataFrame, kb: int = 1000) -> DataFrame:
    """Variant pairs of one chromosome at most ``kb`` kilobases apart, by buckets of that width."""
    width = kb * 1000
    bucket = F.floor(F.col("pos") / width)
    left = indexed.select(
        "chrom",
        F.col("idx").alias("i"),
        F.col("marker_id").alias("marker_i"),
        F.col("pos").alias("pos_i"),
        F.explode(F.array(bucket, bucket + 1)).alias("bucket"),
    )
    right = indexed.select(
        "chrom",
        F.col("idx").alias("j"),
        F.col("marker_id").alias("marker_j"),
        F.col("pos").alias("pos_j"),
        bucket.alias("bucket"),
    )
    return (
        left.join(right, ["chrom", "bucket"])
        .where((F.col("j") > F.col("i")) & (F.col("pos_j") - F.col("pos_i") <= width))
        .drop("bucket", "pos_i", "pos_j")
    )


def _chromosome_file(chrom) -> str:
    return quote(str(chrom), safe="")


def _store_tiles(folder: str, shape: tuple[int, int]):
    """Calls sorted by tile as files of (variant, sample) bytes, -1 where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, calls = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in TILE)))
            row, col, dosage = (batch.column(c).to_numpy() for c in ("row", "col", "dosage"))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if keys[start] != key:
                    if key is not None:
                        write_block(folder, f"{_chromosome_file(key[0])}-{key[1]}-{key[2]}", calls)
                        yield _batch_of_tile(key, batch)
                    key, calls = keys[start], np.full(shape, -1, dtype="int8")
                calls[row[start:end], col[start:end]] = dosage[start:end]
        if key is not None:
            write_block(folder, f"{_chromosome_file(key[0])}-{key[1]}-{key[2]}", calls)
            yield _batch_of_tile(key, batch)

    return run


def _batch_of_tile(key: tuple, like: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], like.schema.field(c).type) for k, c in zip(key, TILE)], TILE)


def _pair_sums(folder: str, span: int, variants: int):
    """Sums over the samples of one sample block, for the variant pairs of two variant blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = Blocks(folder, 2)
        for batch in batches:
            for work in range(batch.num_rows):
                chrom, a, b, sblock, at_a, at_b = (batch.column(c)[work].as_py() for c in ("chrom", "a", "b", "sblock", "at_a", "at_b"))
                x, y = (fetch(f"{_chromosome_file(chrom)}-{k}-{sblock}")[: len(at)] for k, at in ((a, at_a), (b, at_b)))
                in_x, in_y = (x >= 0).astype(np.float32), (y >= 0).astype(np.float32)
                x, y = np.maximum(x, 0).astype(np.float32), np.maximum(y, 0).astype(np.float32)
                n = in_x @ in_y.T
                near = np.subtract.outer(np.array(at_b), np.array(at_a)).T < span
                i, j = np.nonzero((np.triu(near, 1) if a == b else near) & (n > 0))
                grids = (n, x @ in_y.T, in_x @ y.T, (x * x) @ in_y.T, in_x @ (y * y).T, x @ y.T)
                sums = [pa.array(np.rint(grid[i, j]).astype(np.int64)) for grid in grids]
                head = [pa.array([chrom] * len(i), batch.schema.field("chrom").type), pa.array(a * variants + i), pa.array(b * variants + j)]
                yield pa.RecordBatch.from_arrays([*head, *sums], ["chrom", "i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return run


def _block_pairs(indexed: DataFrame, at: Column, span: int, variants: int) -> DataFrame:
    """(chrom, a, b, at_a, at_b): pairs of blocks of ``variants`` that hold variants fewer than ``span`` apart, with their places."""
    place = F.struct((F.col("idx") % variants).alias("row"), at.cast("bigint").alias("at"))
    blocks = indexed.groupBy("chrom", F.floor(F.col("idx") / variants).cast("bigint").alias("block")).agg(
        F.array_sort(F.collect_list(place)).alias("places")
    )
    blocks = write_intermediate(blocks.select("chrom", "block", F.col("places.at").alias("at")), "variant-blocks")
    end = F.floor(F.element_at("at", -1) / span)
    left = blocks.select("chrom", F.col("block").alias("a"), F.col("at").alias("at_a"), F.explode(F.array(end, end + 1)).alias("bucket"))
    right = blocks.select("chrom", F.col("block").alias("b"), F.col("at").alias("at_b"), F.floor(F.get("at", F.lit(0)) / span).alias("bucket"))
    near = F.get("at_b", F.lit(0)) - F.element_at("at_a", -1) < span
    others = left.join(right, ["chrom", "bucket"]).where((F.col("b") > F.col("a")) & near).drop("bucket")
    own = blocks.select("chrom", F.col("block").alias("a"), F.col("block").alias("b"), F.col("at").alias("at_a"), F.col("at").alias("at_b"))
    return own.unionByName(others)


def ld_r2(
    genotypes: DataFrame,
    window: int = LD_WINDOW,
    tile: tuple[int, int] = LD_TILE,
    indexed: DataFrame | None = None,
    kb: int | None = None,
) -> DataFrame:
    """Squared correlation of all variant pairs within the window, over samples called at both (at least one).

    The window is ``window`` variants, or ``kb`` kilobases if that is given. Calls are whole numbers. They are cut into tiles
    of ``tile`` variants by samples, each a file in the shared folder, sent once whatever the window. The work list has a row
    for two blocks of variants within a window of each other and a block of samples; its task fetches two tiles,
    so it needs memory for six grids of variants by variants and four arrays of a tile, however dense the variants are. Pair sums add up over the
    sample blocks.
    """
    variants, width = tile
    span, at = (window, F.col("idx")) if kb is None else (kb * 1000 + 1, F.col("pos"))
    if indexed is None:
        indexed = write_intermediate(variant_index(genotypes), "variants")
    spark = genotypes.sparkSession
    present = genotypes.where(F.col("dosage").isNotNull())
    samples = write_intermediate(sample_index(present), "samples")
    folder = scratch_path(spark, "linkage")
    calls = (
        present.join(broadcast_checked(indexed, 64), VARIANT)
        .join(broadcast_checked(samples, 40), "s")
        .select(
            "chrom",
            F.floor(F.col("idx") / variants).cast("bigint").alias("block"),
            F.floor(F.col("sample_idx") / width).cast("int").alias("sblock"),
            (F.col("idx") % variants).cast("int").alias("row"),
            (F.col("sample_idx") % width).cast("int").alias("col"),
            F.col("dosage").cast("tinyint").alias("dosage"),
        )
    )
    chrom_type = dict(indexed.dtypes)["chrom"]
    stored = calls.repartition(*TILE).sortWithinPartitions(*TILE).mapInArrow(_store_tiles(folder, tile), f"chrom {chrom_type}, block bigint, sblock int")
    stored = write_intermediate(stored, "tiles")
    work = (
        _block_pairs(indexed, at, span, variants)
        .join(stored.withColumnRenamed("block", "a"), ["chrom", "a"])
        .join(stored.withColumnRenamed("block", "b"), ["chrom", "b", "sblock"])
    )
    work = write_intermediate(work, "tile-pairs")
    order = ["chrom", "sblock", "a", "b"]
    dealt = work.repartitionByRange(max(1, -(-work.count() // TILE_PAIRS_PER_TASK)), *order).sortWithinPartitions(*order)
    schema = f"chrom {chrom_type}, i bigint, j bigint, n bigint, sx bigint, sy bigint, sxx bigint, syy bigint, sxy bigint"
    sums = (
        dealt.mapInArrow(_pair_sums(folder, span, variants), schema)
        .groupBy("chrom", "i", "j")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    return _with_markers(sums.select("chrom", "i", "j", _r2().alias("r2")), indexed)


def _r2():
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    cov = n * F.col("sxy") - sx * sy
    return F.try_divide(cov * cov, (n * F.col("sxx") - sx * sx) * (n * F.col("syy") - sy * sy))


def _with_markers(pairs: DataFrame, indexed: DataFrame) -> DataFrame:
    names = indexed.select("chrom", "idx", "marker_id")
    return pairs.join(names.toDF("chrom", "i", "marker_i"), ["chrom", "i"]).join(
        names.toDF("chrom", "j", "marker_j"), ["chrom", "j"]
    )


def ld_prune(
    genotypes: DataFrame,
    window: int = LD_WINDOW,
    max_r2: float | None = None,
    tile: tuple[int, int] = LD_TILE,
    kb: int | None = None,
) -> DataFrame:
    """Variants left after removing one of each linked pair: the one with the lower minor allele
    frequency, then the later one. Linked are variants of one window (of ``window`` variants, or
    ``kb`` kilobases if given) beyond ``max_r2``, by default the usual limit of that kind of window.

    Equal to going through the variants from the highest frequency down and keeping each that has
    no kept partner, but decided in rounds: a variant that loses to no undecided partner stays and
    its partners go. Linked pairs are sparse; each round is two small joins.
    """
    indexed = write_intermediate(variant_index(genotypes), "variants")
    if max_r2 is None:
        max_r2 = LD_R2 if kb is None else LD_KB_R2
    pairs = ld_r2(genotypes, window, tile, indexed, kb).where(F.col("r2") > max_r2)
    maf = with_maf(genotype_counts(genotypes)).select("marker_id", "maf")
    first = F.struct(-F.col("maf_i"), F.col("i"))
    second = F.struct(-F.col("maf_j"), F.col("j"))
    ahead = first < second
    edges = (
        pairs.join(maf.toDF("marker_i", "maf_i"), "marker_i")
        .join(maf.toDF("marker_j", "maf_j"), "marker_j")
        .select(
            F.when(ahead, F.col("marker_i")).otherwise(F.col("marker_j")).alias("winner"),
            F.when(ahead, F.col("marker_j")).otherwise(F.col("marker_i")).alias("loser"),
        )
    )
    removed = remove_linked(edges)
    variants = indexed.select(*VARIANT)
    if removed is None:
        return variants
    return variants.join(removed.withColumnRenamed("loser", "marker_id"), "marker_id", "left_anti").select(*VARIANT)


def remove_linked(edges: DataFrame) -> DataFrame | None:
    """Losers of the greedy removal over (winner, loser) pairs, or None without pairs."""
    rounds = []
    edges = write_intermediate(edges, "linked")
    while not edges.isEmpty():
        undecided = edges.select(F.col("loser").alias("winner")).distinct()
        settled = edges.select("winner").distinct().join(undecided, "winner", "left_anti")
        gone = write_intermediate(
            edges.join(settled, "winner", "left_semi").select("loser").distinct(), "removed"
        )
        rounds.append(gone)
        edges = write_intermediate(
            edges.join(gone, "loser", "left_anti").join(
                gone.withColumnRenamed("loser", "winner"), "winner", "left_anti"
            ),
            "linked",
        )
    return reduce(DataFrame.unionByName, rounds) if rounds else None


def markers_for_variance_ratio(
    genotypes: DataFrame,
    samples: DataFrame,
    per_class: dict[str, int] = {"rare": MARKERS_PER_CLASS, "common": MARKERS_PER_CLASS},
    min_hwe_p: float = MIN_HWE_P,
    tile: tuple[int, int] = LD_TILE,
    kb: float | None = None,
) -> DataFrame:
    """Quality filter, pruning, then the wanted number of markers of each class; fails when a class is
    too small. ``kb`` prunes by length instead of by number of variants."""
    kept = genotypes.join(samples.select("s"), "s", "left_semi")
    passed = variant_qc(kept, min_maf=None, min_hwe_p=min_hwe_p).select("marker_id")
    kept = kept.join(passed, "marker_id", "left_semi")
    pruned = ld_prune(kept, tile=tile, kb=kb)
    counts = allele_counts(kept.join(pruned.select("marker_id"), "marker_id", "left_semi"))
    classes = mac_class(counts)
    assert_min_rows(classes, "mac_class", per_class)
    parts = [
        sample_per_class(classes.where(F.col("mac_class") == name), n) for name, n in per_class.items()
    ]
    return reduce(DataFrame.unionByName, parts)
