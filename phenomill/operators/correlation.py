"""Correlation of phenotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.stats import pearson_p_value


def pearson_corr(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r, its two-sided p-value and the number of pairs; one row."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n")).withColumn(
        "p_value", pearson_p_value("r", F.col("n").cast("double"))
    )


def phecode_pair_corr(pairs: DataFrame, status: DataFrame, population: DataFrame) -> DataFrame:
    """Person-level correlation of the two codes of each phenotype.

    Only TRUE cells are needed: with n persons the four sums of the 0/1 columns are the case counts
    and the number of persons who have both, so non-cases never appear as rows. Each pair meets
    its cases through one join on the code; both-code persons are counted per (pair, person).
    """
    cases = status.where("status").select("person_id", "phecode").distinct()
    sides = pairs.select(
        "phenotype_ID", "phecode_1", "phecode_2", F.explode(F.array("phecode_1", "phecode_2")).alias("phecode")
    ).distinct()
    keys = ["phenotype_ID", "phecode_1", "phecode_2"]
    per_person = (
        sides.join(cases, "phecode")
        .groupBy(*keys, "person_id")
        .agg(
            F.max((F.col("phecode") == F.col("phecode_1")).cast("int")).alias("a"),
            F.max((F.col("phecode") == F.col("phecode_2")).cast("int")).alias("b"),
        )
    )
    n = F.col("n")
    sums = per_person.groupBy(*keys).agg(
        F.sum("a").alias("cases_1"), F.sum("b").alias("cases_2"), F.sum(F.col("a") * F.col("b")).alias("both")
    )
    c1, c2 = F.col("cases_1").cast("double"), F.col("cases_2").cast("double")
    spread = F.sqrt(c1 * (n - c1)) * F.sqrt(c2 * (n - c2))
    r = F.try_divide(n * F.col("both") - c1 * c2, spread)
    return (
        sums.withColumn("n", population.agg(F.count(F.lit(1))).scalar())
        .withColumn("r", r)
        .withColumn("p_value", pearson_p_value("r", n.cast("double")))
    )
