"""Result files whose metadata is in the file name and whose columns differ by file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenomill.sources.headers import files_by_header, read_files

# Default file name pattern (ancestry, trait, variant class) and the excluded marker.
FILE_PATTERN = r"aou_snp_(.*?)_step2_(.*?)_vars_(.*?)\.txt"
FILE_GLOB = "aou_snp_*_step2_*_vars_*.txt*"
EXCLUDED = "ADDITIVE"

NUMERIC = ["AC_Allele2", "AF_Allele2", "BETA", "SE", "Tstat", "var", "N", "N_case", "N_ctrl", "p.value"]
TEXT = ["MarkerID", "Is.SPA"]
# Columns that a file may lack, and the flags that tell.
OPTIONAL = {"N_case": "has_n_case", "AF_Allele2": "has_af", "MarkerID": "has_marker"}


def parse_file_name(df: DataFrame, column: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """Ancestry, Trait and VariantClass from a file name, the three groups of ``pattern``; other names are dropped."""
    name = F.regexp_extract(F.col(column), r"([^/]+)$", 1)
    return df.where(name.rlike(pattern)).withColumns(
        {
            "Ancestry": F.regexp_extract(name, pattern, 1),
            "Trait": F.regexp_extract(name, pattern, 2),
            "VariantClass": F.regexp_extract(name, pattern, 3),
        }
    )


def scan_result_files(
    spark: SparkSession,
    path: str | list[str],
    with_additive: bool = False,
    pattern: str = FILE_PATTERN,
    glob: str = FILE_GLOB,
    excluded: str = EXCLUDED,
) -> DataFrame:
    """All result files under ``path`` as one table with the union of their columns.

    The first line of a file is its header. Files with the same header are one scan, so columns are matched by name
    and no line is joined to anything. The columns above come first, known numbers as doubles, all others as text;
    a column that a file lacks is NULL, and ``has_<column>`` flags tell which optional columns it had.
    """
    parts = []
    for header, files in files_by_header(spark, path, glob).items():
        names = header.split("\t")
        table = read_files(spark, files, names, "\t", quote="")
        if not with_additive:
            table = table.where(~F.regexp_extract("file", r"([^/]+)$", 1).contains(excluded))

        def field(name: str, names=names):
            text = F.col(f"`{name}`") if name in names else F.lit(None).cast("string")
            return F.when(~text.isin("", "NA", "NaN", "nan"), text)

        others = [c for c in table.columns if c not in (*TEXT, *NUMERIC, "file")]
        parts.append(
            table.select(
                "file",
                *[field(c).alias(c) for c in TEXT],
                *[field(c).try_cast("double").alias(c) for c in NUMERIC],
                *[F.lit(c in names).alias(flag) for c, flag in OPTIONAL.items()],
                *[F.col(f"`{c}`") for c in others],
            )
        )
    if not parts:
        schema = ["file string", *[f"`{c}` string" for c in TEXT], *[f"`{c}` double" for c in NUMERIC]]
        parts = [spark.createDataFrame([], ", ".join([*schema, *[f"{flag} boolean" for flag in OPTIONAL.values()]]))]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return parse_file_name(table, "file", pattern).drop("file")
