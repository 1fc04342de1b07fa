"""Diagnosis codes to phecode case / control status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.nulls import join_null_safe
from phenomill.functions.scalar import sex_code
from phenomill.session import write_intermediate

# Vocabularies of diagnosis codes.
ICD_VOCABULARIES = ["ICD9CM", "ICD10CM"]


def filter_vocabulary(concept: DataFrame, vocabularies: list[str] = ICD_VOCABULARIES) -> DataFrame:
    return concept.where(F.col("vocabulary_id").isin(vocabularies))


def join_concept_inner(events: DataFrame, concept: DataFrame, key: str) -> DataFrame:
    return events.join(concept.withColumnRenamed("concept_id", key), key)


def icd_events(branches: list[DataFrame], concept: DataFrame) -> DataFrame:
    """Diagnosis codes of all event branches (person_id, source_concept_id, date) with duplicates.
    One join after the union instead of one per branch."""
    events = reduce(DataFrame.unionByName, branches)
    codes = filter_vocabulary(concept).select("concept_id", "vocabulary_id", "concept_code")
    return join_concept_inner(events, codes, "source_concept_id").select(
        "person_id", "vocabulary_id", "concept_code", "date"
    )


def union_icd_codes(branches: list[DataFrame], concept: DataFrame) -> DataFrame:
    return icd_events(branches, concept).distinct()


def expand_rollup(code_map: DataFrame, rollup: DataFrame) -> DataFrame:
    """Map each diagnosis code to its phecode and every parent of it."""
    parents = rollup.select(F.col("code").alias("phecode"), "phecode_unrolled")
    return code_map.join(parents, "phecode").select(
        "vocabulary_id", F.col("code").alias("concept_code"), F.col("phecode_unrolled").alias("phecode")
    )


def join_code_map(codes: DataFrame, expanded_map: DataFrame) -> DataFrame:
    return codes.join(expanded_map, ["vocabulary_id", "concept_code"])


def code_counts(codes: DataFrame, expanded_map: DataFrame) -> DataFrame:
    """Distinct dates per person and phecode.

    Codes may repeat: the distinct count removes duplicates, spread by person, phecode and date, so
    no separate DISTINCT over the events is needed and a hot person meets in no single task.
    """
    return (
        join_code_map(codes, expanded_map)
        .groupBy("person_id", "phecode")
        .agg(F.countDistinct("date").alias("code_count"))
    )


def filter_ehr_participants(cb_search_person: DataFrame) -> DataFrame:
    return cb_search_person.where(F.col("has_ehr_data") == 1).select("person_id").distinct()


def person_multiplicity(df: DataFrame) -> DataFrame:
    """How many persons occur once, twice, ..."""
    return (
        df.groupBy("person_id")
        .agg(F.count(F.lit(1)).alias("n_site"))
        .groupBy("n_site")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def person_sex(person: DataFrame) -> DataFrame:
    return person.select("person_id", sex_code(F.col("sex_at_birth_concept_id")).alias("sex"))


def missing_population(population: DataFrame, coded: DataFrame) -> DataFrame:
    """Population members without any code."""
    return population.join(coded.select("person_id").distinct(), "person_id", "left_anti")


def phecode_status(
    counts: DataFrame,
    population: DataFrame,
    sex: DataFrame | None = None,
    restrictions: DataFrame | None = None,
    min_count: int = 2,
) -> DataFrame:
    """Case status of every coded (person, phecode) cell inside the population.

    TRUE from ``min_count`` distinct dates, NULL below; NULL for a person outside the code's sex.
    Cells without a row are controls; keeping them implicit keeps the result as small as the
    codes. ``phecode_wide`` fills them in.
    """
    cells = counts.join(population, "person_id", "left_semi").withColumn(
        "status", F.when(F.col("code_count") >= min_count, True)
    )
    if restrictions is not None:
        cells = (
            cells.join(sex, "person_id", "left")
            .join(restrictions, "phecode", "left")
            .withColumn("status", F.when(_sex_fits(), F.col("status")))
        )
    return cells.select("person_id", "phecode", "status")


def _sex_fits():
    """A person of unknown sex fits no restricted code."""
    sex = F.coalesce(F.col("sex"), F.lit("0"))
    wrong = (F.coalesce(F.col("male_only"), F.lit(False)) & (sex != "M")) | (
        F.coalesce(F.col("female_only"), F.lit(False)) & (sex != "F")
    )
    return ~wrong


def phecode_wide(
    counts: DataFrame,
    population: DataFrame,
    phecodes: list[str],
    sex: DataFrame | None = None,
    restrictions: dict[str, str] | None = None,
    min_count: int = 2,
) -> DataFrame:
    """One row per population member, one column per phecode: TRUE case, FALSE control, NULL unclear.

    ``phecodes`` fixes the columns (pass slices of a long list to write several tables).
    ``restrictions`` maps a phecode to the sex (``M`` / ``F``) it is limited to.
    """
    pivoted = (
        counts.where(F.col("phecode").isin(phecodes))
        .groupBy("person_id")
        .pivot("phecode", phecodes)
        .agg(F.max("code_count"))
    )
    wide = population.join(pivoted, "person_id", "left")
    if sex is not None:
        wide = wide.join(sex, "person_id", "left")
    columns = []
    for code in phecodes:
        n = F.col(f"`{code}`")
        status = F.when(n >= min_count, True).when(n.isNull(), False)
        only = (restrictions or {}).get(code)
        if only and sex is not None:
            status = F.when(F.col("sex") == only, status)
        columns.append(status.alias(code))
    return wide.select("person_id", *columns)


def phecode_case_counts(status: DataFrame) -> DataFrame:
    return (
        status.groupBy("phecode").agg(F.count_if("status").alias("cases"))
    )


def pair_case_counts(pairs: DataFrame, status: DataFrame) -> DataFrame:
    """Cases of both codes of each two-code phenotype, ordered by the first; pairs with a code that
    has no column in the data are left out."""
    cases = phecode_case_counts(status)
    return (
        pairs.join(cases.toDF("phecode_1", "cases_1"), "phecode_1")
        .join(cases.toDF("phecode_2", "cases_2"), "phecode_2")
        .select("phenotype_ID", "phecode_1", "phecode_2", "cases_1", "cases_2")
        .orderBy("cases_1", "phenotype_ID", "phecode_1", "phecode_2")
    )


def case_control_breakdown(status: DataFrame, demographics: DataFrame) -> DataFrame:
    """Cases and controls by age group, sex, ancestry, sex x ancestry and age x ancestry.

    Controls are the persons of a cell without a TRUE or unclear status, found by subtraction, so
    no person x code table is built. One aggregate per full cell feeds the five groupings.
    """
    dims = ["age_group", "sex_at_birth", "ancestry"]
    people = demographics.groupBy(*dims).agg(F.count(F.lit(1)).alias("persons"))
    coded = (
        status.join(demographics.select("person_id", *dims), "person_id")
        .groupBy("phecode", *dims)
        .agg(F.count_if("status").alias("cases"), F.count_if(F.col("status").isNull()).alias("unclear"))
    )
    coded = write_intermediate(coded, "coded-cells")
    sets = {
        "age": ["age_group"],
        "sex": ["sex_at_birth"],
        "ancestry": ["ancestry"],
        "sex_ancestry": ["sex_at_birth", "ancestry"],
        "age_ancestry": ["age_group", "ancestry"],
    }
    codes = coded.select("phecode").distinct()
    totals = _grouped_by_sets(people, sets, dims, {"persons": "persons"})
    by_code = _grouped_by_sets(coded, sets, dims, {"cases": "cases", "unclear": "unclear"}, ["phecode"])
    keys = ["breakdown", *dims]
    # The demographic cells are few and fixed; each code gets all of them.
    cells = totals.agg(F.collect_list(F.struct(*keys, "persons"))).scalar()
    grid = codes.select("phecode", F.explode(cells).alias("cell")).select("phecode", "cell.*")
    return join_null_safe(grid, by_code, ["phecode", *keys], "left").select(
        "phecode",
        *keys,
        F.coalesce("cases", F.lit(0)).alias("cases"),
        (
            F.col("persons") - F.coalesce("cases", F.lit(0)) - F.coalesce("unclear", F.lit(0))
        ).alias("controls"),
    )


def _grouped_by_sets(
    df: DataFrame, sets: dict[str, list[str]], dims: list[str], sums: dict[str, str], by: list[str] = ()
) -> DataFrame:
    """Sums per grouping set; ``breakdown`` names the set, unused dimensions are NULL."""
    tagged = df.withColumn(
        "__set",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("breakdown"),
                        *[
                            (F.col(d) if d in used else F.lit(None).cast("string")).alias(d)
                            for d in dims
                        ],
                    )
                    for name, used in sets.items()
                ]
            )
        ),
    )
    return tagged.groupBy(*by, *[F.col(f"__set.{c}").alias(c) for c in ["breakdown", *dims]]).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )
