"""Cohort assembly: joins of phenotypes, covariates and principal components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.nulls import to_number
from phenomill.functions.scalar import normalize_person_id


def with_person_id(df: DataFrame) -> DataFrame:
    return df.withColumn("person_id", normalize_person_id(F.col("person_id")))


def rename_first_column(df: DataFrame, name: str = "person_id") -> DataFrame:
    return df.withColumnRenamed(df.columns[0], name)


def rename_numeric_columns(df: DataFrame, prefix: str = "phe_") -> DataFrame:
    """Prefix columns whose name is all digits."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c.isnumeric()})


def reorder_columns(df: DataFrame, first: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in first]
    return df.select(*[F.col(f"`{c}`") for c in [*first, *rest]])


def expand_scores_to_pcs(df: DataFrame, column: str = "scores", k: int = 20) -> DataFrame:
    """Text or array of scores to columns PC1 .. PCk."""
    if dict(df.dtypes)[column] == "string":
        bare = F.regexp_replace(column, r"[\[\]]", "")
        values = F.transform(F.split(bare, ","), lambda x: to_number(F.trim(x)))
    else:
        values = F.col(column)
    expanded = df.withColumn("__pcs", values)
    return expanded.select(
        *[F.col(f"`{c}`") for c in df.columns if c != column],
        *[F.get("__pcs", F.lit(i)).alias(f"PC{i + 1}") for i in range(k)],
    )


def fill_missing_text(df: DataFrame) -> DataFrame:
    """All columns as text, missing as empty text."""
    return df.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns]
    )


def sex_specific_cohort(df: DataFrame, run: str | None) -> DataFrame:
    """Keep one sex (male 0, female 1); any other ``run`` keeps all."""
    code = {"Male": 0, "Female": 1}.get(run)
    return df if code is None else df.where(F.col("sex").try_cast("double") == code)


def join_person_left(cohort: DataFrame, table: DataFrame) -> DataFrame:
    return with_person_id(cohort).join(with_person_id(table), "person_id", "left")


def join_pcs_strict(covariates: DataFrame, pcs: DataFrame) -> DataFrame:
    return with_person_id(covariates).join(with_person_id(pcs), "person_id")


def combine_covariates_and_pcs(
    covariates: DataFrame, pcs: DataFrame, run: str | None = None, k: int = 20
) -> DataFrame:
    """Covariates and phenotypes of one cohort with its principal components, missing as text ''."""
    scores = expand_scores_to_pcs(rename_first_column(pcs), k=k)
    return fill_missing_text(join_pcs_strict(sex_specific_cohort(covariates, run), scores))


def join_all_phenotypes(tables: dict[str, DataFrame]) -> DataFrame:
    """Full outer join of any number of person tables by one group-by instead of a chain of joins.

    Every table holds at most one row per person. A column name that occurs twice gets the table
    name as suffix.
    """
    names = [c for df in tables.values() for c in df.columns if c != "person_id"]
    clashing = {c for c in names if names.count(c) > 1}
    renamed = [
        df.withColumnsRenamed({c: f"{c}_{name}" for c in df.columns if c in clashing})
        for name, df in tables.items()
    ]
    columns = [c for df in renamed for c in df.columns if c != "person_id"]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)
    return stacked.groupBy("person_id").agg(
        *[F.max(F.col(f"`{c}`")).alias(c) for c in columns]
    )


def medians_wide(long: DataFrame, keys: list[str]) -> DataFrame:
    """(person_id, concept_key, median) to one ``median_<key>`` column per listed key."""
    wide = long.groupBy("person_id").pivot("concept_key", keys).agg(F.max("median"))
    return wide.withColumnsRenamed({k: f"median_{k}" for k in keys})


def semi_join_samples(df: DataFrame, samples: DataFrame, key: str = "s") -> DataFrame:
    return df.join(samples.select(key), key, "left_semi")


def anti_join_samples(df: DataFrame, flagged: DataFrame, key: str = "s") -> DataFrame:
    return df.join(flagged.select(key), key, "left_anti")


def ancestry_cohorts(
    ancestry: DataFrame, flagged: DataFrame, genotyped: DataFrame, min_probability: float = 0.75
) -> DataFrame:
    """Unflagged genotyped samples per ancestry, the ancestry kept as a key."""
    confident = ancestry.where(F.col("prob") > min_probability).select("ancestry", "s")
    return semi_join_samples(anti_join_samples(confident, flagged), genotyped)


def run_grid(
    phenotypes: DataFrame,
    ancestries: list[str],
    prune_methods: list[str],
    variant_classes: list[str],
    finished: DataFrame | None = None,
) -> DataFrame:
    """Every run of ancestry x prune method x phenotype x variant class that is not finished yet."""
    grid = phenotypes
    for name, values in (
        ("ancestry", ancestries),
        ("prune_method", prune_methods),
        ("variant_class", variant_classes),
    ):
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    if finished is not None:
        grid = grid.join(finished, [c for c in finished.columns if c in grid.columns], "left_anti")
    return grid


def preview(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)
