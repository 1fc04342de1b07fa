"""Writers. All write folders of part files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenomill.sources.genotypes import BED_CODES, BED_MAGIC

# Samples of a variant that are encoded at once; a multiple of four.
BED_PIECE = 4096


def _flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, quoted: bool = True, mode: str = "overwrite") -> None:
    """Comma-separated with a header; ``quoted=False`` never quotes."""
    writer = _flat(df).write.mode(mode).option("header", True).option("emptyValue", "")
    if not quoted:
        writer = writer.option("quote", "\u0000")
    writer.csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    _flat(df).write.mode(mode).option("header", True).option("sep", "\t").option("emptyValue", "").option(
        "compression", compression
    ).csv(path)


def write_gzip_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_tsv(df, path, mode, "gzip")


def write_catalogue_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def write_genotypes(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("chrom").parquet(path)


def write_plink(variants: DataFrame, samples: DataFrame, prefix: str) -> None:
    """Variant rows as one bed / bim / fam set, the first bim allele being ``alt``.

    A bed file is one stream in variant order, so one task writes it, some thousand samples at a time: give each chromosome its own
    set. The bim and fam are folders of one part file.
    """
    code = np.full(4, BED_CODES.index(-1), dtype=np.uint8)
    code[:3] = [BED_CODES.index(g) for g in (0, 1, 2)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = prefix + ".bed"
        system, path = fs.FileSystem.from_uri(name) if ":/" in name else (fs.LocalFileSystem(), name)
        system.create_dir(path.rsplit("/", 1)[0])
        with system.open_output_stream(path) as out:
            out.write(BED_MAGIC)
            for batch in batches:
                for row in range(batch.num_rows):
                    calls = batch.column("calls")[row].values.fill_null(3).to_numpy().astype(np.uint8)
                    quads = np.zeros(-(-len(calls) // 4) * 4, dtype=np.uint8)
                    quads[: len(calls)] = code[calls]
                    quads = quads.reshape(-1, 4)
                    # Four samples per byte, lowest bits first.
                    out.write((quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column("value").drop_null()], ["value"])

    line = F.concat_ws("\t", F.col("chrom").cast("string"), "marker_id", F.lit("0"), F.col("pos").cast("string"), "alt", "ref")
    rows = variants.select("chrom", "pos", "marker_id", line.alias("value"), F.col("dosages").cast("array<tinyint>").alias("dosages"))
    ordered = rows.coalesce(1).sortWithinPartitions("chrom", "pos", "marker_id")
    starts = F.sequence(F.lit(0), F.greatest(F.size("dosages") - 1, F.lit(0)), F.lit(BED_PIECE))
    pieces = ordered.select("value", "dosages", F.explode(starts).alias("start")).select(
        F.when(F.col("start") == 0, F.col("value")).alias("value"), F.slice("dosages", F.col("start") + 1, BED_PIECE).alias("calls")
    )
    pieces.mapInArrow(encode, "value string").write.mode("overwrite").text(prefix + ".bim")
    name = F.col("s").cast("string")
    family = samples.coalesce(1).sortWithinPartitions("sample_idx").select(F.concat_ws(" ", name, name, F.lit("0 0 0 -9")).alias("value"))
    family.write.mode("overwrite").text(prefix + ".fam")


def write_eigenvalues(df: DataFrame, path: str) -> None:
    """``PC`` (from 1) and ``Eigenvalue``."""
    write_tsv(df.select("PC", "Eigenvalue").orderBy("PC"), path)


def eigenvalue_rows(df: DataFrame, column: str) -> DataFrame:
    """Array of eigenvalues to numbered rows."""
    rows = df.select(F.posexplode(column).alias("at", "Eigenvalue"))
    return rows.select((F.col("at") + 1).alias("PC"), "Eigenvalue")


def write_person_summary(df: DataFrame, path: str, concept_key: str | None = None) -> None:
    """Person summaries of all labs in one table, a folder per concept key (``a_b`` for two concepts)."""
    if concept_key is not None:
        df = df.withColumn("concept_key", F.lit(concept_key))
    df.write.mode("overwrite").partitionBy("concept_key").parquet(path)


def write_sample_ids(df: DataFrame, path: str, column: str = "person_id") -> None:
    """One id per line, without a header line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
