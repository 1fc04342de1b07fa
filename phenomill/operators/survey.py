"""Survey questions, answer distributions and procedure status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.nulls import true_or_false

# Answer texts and their codes; two answers become empty text.
SEX_ANSWER_CODES = {
    "Sex At Birth: Male": "M",
    "Sex At Birth: Female": "F",
    "Sex At Birth: Intersex": "",
    "Sex At Birth: Sex At Birth None Of These": "",
    "PMI: Skip": "PMI: Skip",
}

# Procedure concepts of hip replacement.
HIP_PROCEDURES = [4134857, 398010007]

# Fixed value: concept of the sex-at-birth question.
SEX_AT_BIRTH_QUESTION = 1585845


def filter_survey(df: DataFrame, survey: str | None = None, question: int | None = None) -> DataFrame:
    if survey is not None:
        df = df.where(F.col("survey") == survey)
    if question is not None:
        df = df.where(F.col("question_concept_id") == question)
    return df


def survey_question_counts(df: DataFrame, survey: str = "The Basics", strict: bool = True) -> DataFrame:
    """Participants per topic and question of one survey. ``strict`` fails on a question without
    ``": "``; otherwise its question text is NULL."""
    parts = F.split("question", ": ")
    second = F.element_at(parts, 2) if strict else F.get(parts, F.lit(1))
    return (
        filter_survey(df, survey)
        .groupBy(parts[0].alias("topic"), second.alias("question"), "question_concept_id")
        .agg(F.countDistinct("person_id").alias("N_participants"))
        .orderBy("topic", "question_concept_id")
    )


def share_of_total(df: DataFrame, group: str, count: str = "person_id") -> DataFrame:
    """Distinct persons per group next to their total over all groups."""
    per_group = df.groupBy(group).agg(F.countDistinct(count).alias("n"))
    return per_group.withColumn("total", per_group.agg(F.sum("n")).scalar())


def answer_distribution(df: DataFrame, question: int) -> DataFrame:
    """Participants and percentage per answer, largest first, and a TOTAL row at the end."""
    shares = share_of_total(filter_survey(df, question=question), "answer")
    answers = shares.select(
        F.col("answer").alias("Answer"),
        F.col("n").alias("N_participants"),
        F.round(100 * (F.col("n") / F.col("total")), 2).alias("Percentage"),
    )
    total = answers.agg(
        F.lit("TOTAL").alias("Answer"),
        F.sum("N_participants").alias("N_participants"),
        F.bround(F.sum("Percentage")).alias("Percentage"),
    )
    stripped = F.regexp_replace("Answer", "PMI: ", "").alias("Answer")
    return (
        answers.withColumn("__last", F.lit(0))
        .unionByName(total.withColumn("__last", F.lit(1)))
        .orderBy("__last", F.desc("N_participants"), "Answer")
        .select(stripped, "N_participants", "Percentage")
    )


def observation_answers(
    observation: DataFrame, concept: DataFrame, question: int = SEX_AT_BIRTH_QUESTION, out: str = "sex_at_birth"
) -> DataFrame:
    """Answer concept name per person for one survey question in the observation table."""
    answers = observation.where(F.col("observation_concept_id") == question)
    names = concept.select(F.col("concept_id").alias("value_source_concept_id"), "concept_name")
    return answers.join(names, "value_source_concept_id").select(
        "person_id", F.col("concept_name").alias(out)
    )


def recode_values(df: DataFrame, column: str, codes: dict[str, str]) -> DataFrame:
    """Replace listed values; others stay."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(table, F.col(column)), F.col(column)))


def join_procedure_status(
    procedures: DataFrame,
    persons: DataFrame,
    concepts: list[int] = HIP_PROCEDURES,
    out: str | None = None,
    one_row: bool = True,
) -> DataFrame:
    """Whether each person (with or without a procedure row) has a listed procedure.

    With ``one_row=False`` the distinct (person, flag) pairs: someone with several procedures can then have
    both a TRUE and a FALSE row.
    """
    flag = out or f"is_concept_{concepts[0]}"
    rows = procedures.select("person_id", F.col("procedure_concept_id").isin(concepts).alias("listed"))
    joined = rows.groupBy("person_id", *(() if one_row else ("listed",))).agg(F.max("listed").alias("any"))
    return persons.select("person_id").distinct().join(joined, "person_id", "full").select(
        "person_id", true_or_false(F.col("any")).alias(flag)
    )
