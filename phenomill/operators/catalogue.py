"""Phenotype catalogue: code lists, crosswalks, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.functions.scalar import (
    notebook_name,
    prefix_code_list,
    split_codes,
    survey_short_name,
)


def lookup_join(
    df: DataFrame, table: DataFrame, key: str, value: str, out: str, default: Column, order: str | None = None
) -> DataFrame:
    """Dictionary lookup: ``value`` of the matching ``key``, else ``default``. With repeated keys in
    the table the one with the largest ``order`` counts."""
    pick = F.max_by(value, order) if order else F.max(value)
    unique = table.groupBy(F.col(key).alias("__key")).agg(
        pick.alias("__value"), F.lit(True).alias("__hit")
    )
    return (
        df.join(unique, df[f"`{key}`"] == unique["__key"], "left")
        .withColumn(out, F.when(F.col("__hit"), F.col("__value")).otherwise(default))
        .drop("__key", "__value", "__hit")
    )


def attach_codes(
    catalogue: DataFrame, crosswalk: DataFrame, source: str = "source_code", target: str = "target_code", order: str = "ord"
) -> DataFrame:
    """Set ``phecode`` of the catalogue entries whose id is a ``source`` code of the crosswalk."""
    keyed = crosswalk.withColumnRenamed(source, "phenotype_ID")
    return lookup_join(catalogue, keyed, "phenotype_ID", target, "phecode", F.col("phecode"), order)


def explode_phecodes(catalogue: DataFrame, order: str = "ord") -> DataFrame:
    """One row per phecode with the settings of the last catalogue entry that names it."""
    settings = ["phenotype_ID", "trait_type", "invnormalise", "tol", "sex_specific_run"]
    rows = catalogue.select(
        F.explode(split_codes(F.col("phecode"))).alias("phecode"), F.struct(*settings).alias("__s"), order
    )
    return (
        rows.groupBy("phecode").agg(F.max_by("__s", order).alias("__s")).select("phecode", "__s.*")
    )


def prefix_numeric_code(catalogue: DataFrame) -> DataFrame:
    """Catalogue with ``phe_`` in front of every numeric code of its list."""
    return catalogue.withColumn(
        "phecode", F.array_join(prefix_code_list(F.col("phecode")), ", ")
    )


def filter_phenotype_codes(catalogue: DataFrame, wanted: list[str]) -> DataFrame:
    return catalogue.where(F.col("phenotype_ID").isin(wanted)) if wanted else catalogue


def sorted_phenotypes(catalogue: DataFrame) -> DataFrame:
    return (
        catalogue.select(F.explode(split_codes(F.col("phecode"))).alias("phecode"))
        .distinct()
        .orderBy("phecode")
    )


def filter_two_phecode(catalogue: DataFrame) -> DataFrame:
    """Phenotypes made of exactly two codes."""
    parts = F.transform(F.split("phecode", ","), lambda c: F.trim(c))
    return catalogue.withColumn("__p", parts).where(F.size("__p") == 2).select(
        "phenotype_ID", F.col("__p")[0].alias("phecode_1"), F.col("__p")[1].alias("phecode_2")
    )


def phenotype_index(concepts: DataFrame, data_type: str, key: str, link: str) -> DataFrame:
    """Index of the phenotypes of one data type: names, notebook file and its address."""
    names = [F.lower("concept_name").alias("concept_name")]
    if data_type == "pfhh":
        names.append(survey_short_name(F.col("concept_name")).alias("short_name"))
    return (
        concepts.select(F.col(key).alias(key), *names)
        .distinct()
        .withColumn("notebook_name", notebook_name(data_type, F.col(key)))
        .withColumn("notebook_url", F.concat(F.lit(link.rstrip("/") + "/"), "notebook_name"))
        .orderBy("concept_name", key)
    )
