"""Delimited files whose headers differ: read by header, matched by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files_by_header(spark: SparkSession, path: str | list[str], glob: str) -> dict[str, list[str]]:
    """Header line to its files, for all files under ``path`` whose name matches ``glob``.

    The header is a file's first line, whatever it says. Only the first split of a file is looked at. The driver gets
    a line per file, as it does when Spark lists the files. Files without a line are left out.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    )
    # Ids ascend within a split, and a file's first split is read by one task.
    first = (
        lines.where("start = 0")
        .withColumn("id", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("value", "id").alias("header"))
    )
    found: dict[str, list[str]] = {}
    for row in first.toLocalIterator():
        found.setdefault(row["header"].removeprefix("﻿").rstrip("\r"), []).append(row["file"])
    return {header: sorted(files) for header, files in sorted(found.items())}


def read_files(spark: SparkSession, files: list[str], names: list[str], sep: str, quote: str = '"') -> DataFrame:
    """Text columns ``names`` of files that share a header, and ``file``. Repeated and empty names get a number."""
    unique: list[str] = []
    for name in names:
        name = name or "unnamed"
        unique.append(name if name not in unique else f"{name}_{len(unique) + 1}")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in unique)
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", quote)
    return reader.csv(files).withColumn("file", F.col("_metadata.file_path"))
