"""Genotype files: PLINK bed/bim/fam and VCF dosages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenomill.session import broadcast_checked, write_intermediate

# The three leading bytes of a variant-major bed file, and the count of the first bim
# allele for the 2-bit codes 00, 01, 10, 11 (-1: missing).
BED_MAGIC = b"\x6c\x1b\x01"
BED_CODES = [2, -1, 1, 0]
# Variants that are decoded at once, and calls of a task.
BED_ROWS = 16
CALLS_PER_TASK = 1 << 20


def with_line_number(lines: DataFrame) -> DataFrame:
    """Add ``line_no`` (from 0) to a text scan: the place within the split plus the lines before it."""
    placed = lines.withColumn("__id", F.monotonically_increasing_id()).select(
        *lines.columns,
        F.shiftright("__id", 33).alias("__part"),
        F.col("__id").bitwiseAND((1 << 33) - 1).alias("__at"),
    )
    # One row per file split.
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__lines"))
    offsets = sizes.select(
        "__part", (F.sum("__lines").over(Window.orderBy("__part")) - F.col("__lines")).alias("__offset")
    )
    return (
        placed.join(offsets, "__part")
        .withColumn("line_no", F.col("__offset") + F.col("__at"))
        .drop("__part", "__at", "__offset")
    )


def scan_bim(spark: SparkSession, path: str) -> DataFrame:
    """Variants in file order; ``alt`` is the first allele, whose copies the bed file counts."""
    fields = with_line_number(spark.read.text(path)).withColumn("f", F.split(F.trim("value"), r"\s+"))
    f = F.col("f")
    return fields.select(
        F.col("line_no").alias("variant_idx"),
        f[0].alias("chrom"),
        f[3].cast("bigint").alias("pos"),
        f[1].alias("marker_id"),
        f[5].alias("ref"),
        f[4].alias("alt"),
    )


def scan_fam(spark: SparkSession, path: str) -> DataFrame:
    """Samples in file order."""
    fields = with_line_number(spark.read.text(path))
    return fields.select(
        F.col("line_no").alias("sample_idx"), F.split(F.trim("value"), r"\s+")[1].alias("s")
    )


def scan_plink(spark: SparkSession, prefix: str, variants_per_task: int = 256) -> DataFrame:
    """Variant rows (chrom, pos, marker_id, ref, alt, dosages in fam order; NULL for a missing call).

    A bed file has a fixed number of bytes per variant. The lines of the bim are the work list: they are dealt in file order, each task
    seeks to its variants and decodes a few at a time, so the file is read once and in parallel, and no dosages are joined.
    A task has ``variants_per_task`` variants, or ``CALLS_PER_TASK`` calls if these are fewer.
    """
    n_samples = spark.read.text(prefix + ".fam").count()
    n_variants = spark.read.text(prefix + ".bim").count()
    width = -(-n_samples // 4)
    bed = prefix + ".bed"
    columns = ["chrom", "pos", "marker_id", "ref", "alt"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(BED_CODES, dtype="int8")
        for batch in batches:
            places = batch.column("variant_idx").to_numpy()
            ends = [i for i in range(1, len(places)) if places[i] != places[i - 1] + 1]
            system, name = fs.FileSystem.from_uri(bed if ":/" in bed else "file://" + bed)
            with system.open_input_file(name) as handle:
                if handle.read(3) != BED_MAGIC:
                    raise ValueError(f"{bed} is not a variant-major bed file")
                for first, last in zip([0, *ends], [*ends, len(places)]):
                    for start in range(first, last, BED_ROWS):
                        count = min(BED_ROWS, last - start)
                        handle.seek(3 + int(places[start]) * width)
                        raw = np.frombuffer(handle.read(count * width), dtype="uint8").reshape(count, width)
                        # Four samples per byte, lowest bits first.
                        codes = np.stack([(raw >> shift) & 3 for shift in (0, 2, 4, 6)], axis=-1)
                        calls = table[codes.reshape(count, width * 4)[:, :n_samples]].ravel()
                        offsets = pa.array(np.arange(count + 1) * n_samples, pa.int32())
                        dosages = pa.ListArray.from_arrays(offsets, pa.array(calls, mask=calls < 0))
                        part = batch.slice(start, count)
                        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), dosages], [*columns, "dosages"])

    per_task = max(1, min(variants_per_task, CALLS_PER_TASK // max(1, n_samples)))
    tasks = max(1, min(-(-n_variants // per_task), 100_000))
    ranges = scan_bim(spark, prefix + ".bim").repartitionByRange(tasks, "variant_idx").sortWithinPartitions("variant_idx")
    return ranges.mapInArrow(decode, "chrom string, pos bigint, marker_id string, ref string, alt string, dosages array<tinyint>")


def to_long(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """Variant rows with dosage arrays to one row per variant and sample.

    The samples are broadcast, up to a million of them; beyond that both sides are merged. The optimizer can't know how long
    the arrays are, so it must not choose to broadcast the rows made of them.
    """
    keys = [c for c in variants.columns if c != "dosages"]
    exploded = variants.select(*keys, F.posexplode("dosages").alias("sample_idx", "dosage"))
    return exploded.hint("merge").join(broadcast_checked(samples, 64, 64 << 20), "sample_idx").drop("sample_idx")


def scan_vcf_dosage(
    spark: SparkSession, path: str | list[str], chrom: str | None = None, field: str = "DS"
) -> DataFrame:
    """Long dosages (chrom, pos, marker_id, ref, alt, s, dosage) of VCF text, plain or gzip.

    Sample names come from the header line of the same file; entries find theirs by file and column, so no file
    is one join key. A missing entry is NULL.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    names = F.expr("slice(split(value, '\t'), 10, size(split(value, '\t')))")
    samples = write_intermediate(
        lines.where(F.col("value").startswith("#CHROM")).select("file", F.posexplode(names).alias("column", "s")), "vcf-samples"
    )
    body = lines.where(~F.col("value").startswith("#"))
    if chrom is not None:
        body = body.where(F.col("value").startswith(chrom + "\t"))
    fields = body.select("file", F.split("value", "\t").alias("f"))
    at = F.array_position(F.split(F.col("f")[8], ":"), field)
    entries = fields.where(at > 0).select(
        "file",
        F.col("f")[0].alias("chrom"),
        F.col("f")[1].cast("bigint").alias("pos"),
        F.col("f")[2].alias("marker_id"),
        F.col("f")[3].alias("ref"),
        F.col("f")[4].alias("alt"),
        (at - 1).cast("int").alias("at"),
        F.posexplode(F.expr("slice(f, 10, size(f))")).alias("column", "entry"),
    )
    value = F.get(F.split("entry", ":"), F.col("at"))
    return entries.join(samples, ["file", "column"]).select(
        "chrom", "pos", "marker_id", "ref", "alt", "s", value.try_cast("double").alias("dosage")
    )
