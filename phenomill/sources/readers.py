"""Readers with explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenomill.functions.nulls import nan_to_null
from phenomill.sources.headers import files_by_header, read_files

DICTIONARIES = ["metadata", "unit_map", "unit_reduce", "site_drop"]

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("phenotype", T.StringType()),
        T.StructField("sex_specific_run", T.StringType()),
        T.StructField("phenotype_ID", T.StringType()),
        T.StructField("definition", T.StringType()),
        T.StructField("trait_type", T.StringType()),
        T.StructField("invnormalise", T.StringType()),
        T.StructField("tol", T.DoubleType()),
        T.StructField("phecode", T.StringType()),
    ]
)


def scan_omop(spark: SparkSession, location: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """One clinical table from ``location`` (a folder of Parquet tables, or a catalog schema when it
    has no slash); NaN becomes NULL."""
    if "/" not in location:
        return nan_to_null(spark.table(f"{location}.{table}"))
    reader = spark.read.schema(schema) if schema else spark.read
    return nan_to_null(reader.parquet(f"{location.rstrip('/')}/{table}.parquet"))


def sql_query(spark: SparkSession, query: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a query over named frames."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def scan_dictionaries(spark: SparkSession, path: str, version: str = "v1_0") -> dict[str, DataFrame]:
    """Versioned lookup tables ``<path>/<version>/<name>_<version>``."""
    return {
        name: nan_to_null(spark.read.parquet(f"{path.rstrip('/')}/{version}/{name}_{version}"))
        for name in DICTIONARIES
    }


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
) -> DataFrame:
    """CSV or TSV; without a schema every column is text (types are never guessed)."""
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote)
    return (reader.schema(schema) if schema else reader).csv(path)


def scan_whitespace(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """Fields separated by any run of blanks, as text; a header line starts with the first name."""
    fields = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"))
    if header:
        fields = fields.where(F.col("f")[0] != columns[0])
    return fields.select(*[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def header_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def scan_external_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Code map staged as CSV with one header row: vocabulary_id, concept_code, phecode."""
    return scan_delimited(spark, path, "vocabulary_id string, concept_code string, phecode string")


def scan_phenotype_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """JSON array of phenotype definitions, or with ``lines`` one object per line, as ``write_catalogue_json``
    gives them. ``ord`` follows the file order; bare NaN codes are NULL."""
    return (
        spark.read.option("multiLine", not lines)
        .schema(CATALOGUE_SCHEMA)
        .json(path)
        .withColumn("phecode", F.nullif(F.col("phecode"), F.lit("NaN")))
        .withColumn("ord", F.monotonically_increasing_id())
    )


def file_name() -> F.Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)


def scan_measurement_summaries(
    spark: SparkSession,
    path: str,
    pattern: str = r"measurement_([\d_]+)_summary\.csv",
    glob: str = "measurement_*_summary.csv*",
) -> DataFrame:
    """(person_id, concept_key, median) of all summary files under ``path``, matched by name in each file.

    The key is the group of ``pattern``. A file without a median has NULLs; one without person_id is an error.
    """
    parts = []
    for header, files in files_by_header(spark, path, glob).items():
        names = [n.strip().strip('"') for n in header.split(",")]
        if "person_id" not in names:
            raise ValueError(f"no person_id in {files[0]}")
        table = read_files(spark, files, names, ",")
        median = F.col("median").try_cast("double") if "median" in names else F.lit(None).cast("double")
        parts.append(
            table.select(
                F.col("person_id").cast("bigint").alias("person_id"),
                F.regexp_extract("file", pattern, 1).alias("concept_key"),
                median.alias("median"),
            )
        )
    if not parts:
        return spark.createDataFrame([], "person_id bigint, concept_key string, median double")
    return reduce(DataFrame.unionByName, parts)


def scan_sample_list(spark: SparkSession, path: str, header: bool = True, sep: str = "\t") -> DataFrame:
    """First column of a sample file as ``s``."""
    table = scan_delimited(spark, path, sep=sep, header=header)
    return table.select(F.trim(F.col(f"`{table.columns[0]}`")).alias("s")).distinct()
