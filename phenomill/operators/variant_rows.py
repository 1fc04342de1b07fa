"""Genotypes as variant rows: (chrom, pos, marker_id, [ref, alt,] dosages), one array element for each sample.

The base form of a genotype table. Samples are a table (sample_idx, s), and all arrays have that order; a missing
call is NULL. Statistics are aggregates of a row's own array, so they need no shuffle. The operators of
``genotypes`` and ``structure`` take this form as well as long rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.functions.ranks import ordered_prefix
from phenomill.session import broadcast_checked, write_intermediate

VARIANT = ["chrom", "pos", "marker_id"]
ALLELES = ["ref", "alt"]
PIECE = 1024


def is_variant_rows(genotypes: DataFrame) -> bool:
    return "dosages" in genotypes.columns


def variant_key(genotypes: DataFrame) -> list[str]:
    """The full key of a variant: with its alleles where the table has them."""
    return VARIANT + [c for c in ALLELES if c in genotypes.columns]


def sample_index(samples: DataFrame) -> DataFrame:
    """(sample_idx, s): the samples in the order of their names, each once."""
    ordered = ordered_prefix(samples.select("s").distinct().withColumn("__all", F.lit(0)), ["__all"], ["s"])
    return ordered.select(F.col("__before").cast("int").alias("sample_idx"), "s")


def from_long(genotypes: DataFrame, samples: DataFrame) -> DataFrame:
    """Variant rows of long rows; ``samples`` is a written ``sample_index``.

    Samples without a row for a variant are missing there; of several rows one counts. Arrays are built in pieces of
    ``PIECE`` samples, so no group gathers more than that many rows.
    """
    key = variant_key(genotypes)
    n = samples.count()
    kind = dict(genotypes.dtypes)["dosage"]
    at = F.col("sample_idx") % PIECE
    rows = genotypes.join(broadcast_checked(samples, 40), "s")
    pieces = rows.groupBy(*key, F.floor(F.col("sample_idx") / PIECE).cast("int").alias("piece")).agg(
        F.collect_list(F.struct(at.alias("at"), F.col("dosage").cast("double").alias("g"))).alias("found")
    )
    pieces = pieces.select(*key, "piece", F.col("found.at").alias("at"), F.col("found.g").alias("g"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, values = batch.column("at"), batch.column("g").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
            sizes = np.minimum(PIECE, n - batch.column("piece").to_numpy().astype(np.int64) * PIECE)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            flat = np.full(int(offsets[-1]), np.nan)
            flat[offsets[row] + found.flatten().to_numpy()] = values
            dosages = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, from_pandas=True))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*key, "piece"]), dosages], [*key, "piece", "dosages"])

    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes if c not in ("at", "g")) + ", dosages array<double>"
    filled = pieces.mapInArrow(fill, schema)
    last = -(-n // PIECE) - 1
    gathered = filled.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("piece", "dosages"))).alias("pieces"))
    # A piece in which the variant has no row is all missing.
    whole = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(last)),
            lambda i: F.coalesce(
                F.try_element_at("pieces", i),
                F.array_repeat(F.lit(None).cast("double"), F.least(F.lit(PIECE), F.lit(n) - i * PIECE).cast("int")),
            ),
        )
    )
    return gathered.select(*key, whole.cast(f"array<{kind}>").alias("dosages"))


def restrict(variants: DataFrame, samples: DataFrame, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(variants, samples) with only the samples of ``keep`` (s), in the same order.

    The places that stay are one array of at most a variant's own length, which is what is broadcast.
    """
    kept = write_intermediate(sample_index(samples.join(keep.select("s").distinct(), "s", "left_semi")), "kept-samples")
    places = samples.join(kept.select("s"), "s", "left_semi").agg(F.sort_array(F.collect_list(F.struct("s", "sample_idx"))).alias("p"))
    places = write_intermediate(places.select(F.col("p.sample_idx").alias("places"), F.lit(0).alias("__one")), "kept-places")
    chosen = F.transform("places", lambda i: F.get("dosages", i))
    rows = variants.withColumn("__one", F.lit(0)).join(F.broadcast(places), "__one")
    return rows.select(*[c for c in variants.columns if c != "dosages"], chosen.alias("dosages")), kept


def called() -> Column:
    return F.size(F.filter("dosages", lambda d: d.isNotNull()))


def copies() -> Column:
    """Sum of the dosages, 0 without a call."""
    return F.aggregate("dosages", F.lit(0.0), lambda total, d: total + F.coalesce(d.cast("double"), F.lit(0.0)))


def having(dosage: int) -> Column:
    return F.size(F.filter("dosages", lambda d: d == dosage)).cast("bigint")
