"""Demographics, covariates, physical measurements and their breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.quantiles import exact_median, summarize_counts
from phenomill.functions.scalar import age_group
from phenomill.operators.phecodes import _grouped_by_sets

# Source names of the program's physical measurements, in lower case.
PHYSICAL_MEASUREMENTS = [
    "weight",
    "height",
    "waist-circumference-mean",
    "hip-circumference-mean",
    "heart-rate-mean",
    "blood-pressure-diastolic-mean",
    "blood-pressure-systolic-mean",
]
COVARIATES = ["person_id", "age", "age2", "age_sex", "age2_sex", "sex"]


def distinct_demographics(cb_search_person: DataFrame) -> DataFrame:
    return cb_search_person.select("person_id", "age_at_cdr", "sex_at_birth").distinct()


def with_age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("age_group", age_group(F.col("age_at_cdr")))


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def filter_demographics(df: DataFrame, max_age: int = 100) -> DataFrame:
    return drop_missing(df, ["age_at_cdr", "sex_at_birth"]).where(
        (F.col("age_at_cdr") <= max_age) & F.col("sex_at_birth").isin("Female", "Male")
    )


def derive_covariates(df: DataFrame) -> DataFrame:
    """Integer age, its square, and both times sex (female 1, male 0)."""
    age, sex = F.col("age_at_cdr").cast("int").cast("bigint"), F.when(F.col("sex_at_birth") == "Female", 1).otherwise(0)
    return (
        df.withColumns({"age": age, "sex": sex.cast("bigint")})
        .withColumn("age2", F.col("age") * F.col("age"))
        .withColumns({"age_sex": F.col("age") * F.col("sex"), "age2_sex": F.col("age2") * F.col("sex")})
        .select(*COVARIATES)
    )


def filter_source_values(df: DataFrame, names: list[str] = PHYSICAL_MEASUREMENTS) -> DataFrame:
    """Rows whose lower-cased source value is listed. Listed names in upper case never match."""
    return df.where(F.lower("measurement_source_value").isin(names))


def pivot_median(df: DataFrame, names: list[str], **limits) -> DataFrame:
    """Median per person and source value over distinct rows, one column per name."""
    rows = filter_source_values(df, names).select(
        "person_id", F.lower("measurement_source_value").alias("source"), "value_as_number"
    )
    # Reading each distinct value once is the extract's DISTINCT.
    medians = exact_median(
        rows.distinct(), ["person_id", "source"], "value_as_number", sized_by=rows, **limits
    )
    return medians.groupBy("person_id").pivot("source", names).agg(F.max("median"))


def derive_bmi_whr(pm: DataFrame) -> DataFrame:
    meters = F.col("height") / 100
    return pm.withColumn("height_m", meters).withColumns(
        {
            "BMI": F.try_divide(F.col("weight"), F.col("height_m") * F.col("height_m")),
            "waist_hip_ratio": F.try_divide(
                F.col("`waist-circumference-mean`"), F.col("`hip-circumference-mean`")
            ),
        }
    )


def ols_residual(df: DataFrame, y: str, x: str, out: str) -> DataFrame:
    """Residual of y on 1 + x over complete rows. Slope and intercept are one aggregate."""
    complete = drop_missing(df, [x, y])
    line = complete.agg(
        F.struct(
            F.regr_slope(F.col(f"`{y}`"), F.col(f"`{x}`")).alias("slope"),
            F.regr_intercept(F.col(f"`{y}`"), F.col(f"`{x}`")).alias("intercept"),
        )
    ).scalar()
    return (
        complete.withColumn("__line", line)
        .withColumn(out, F.col(y) - (F.col("__line.intercept") + F.col("__line.slope") * F.col(x)))
        .drop("__line")
    )


def bmi_whradjbmi(pm: DataFrame) -> DataFrame:
    return ols_residual(derive_bmi_whr(pm), "waist_hip_ratio", "BMI", "WHRadjBMI").select(
        "person_id", "BMI", "WHRadjBMI"
    )


def continuous_breakdown(
    values: DataFrame, demographics: DataFrame, value: str, **limits
) -> DataFrame:
    """Person counts, moments and quartiles of a measurement by age group, sex, ancestry,
    sex x ancestry and age x ancestry, next to the overall row."""
    dims = ["age_group", "sex_at_birth", "ancestry"]
    sets = {
        "all": [],
        "age": ["age_group"],
        "sex": ["sex_at_birth"],
        "ancestry": ["ancestry"],
        "sex_ancestry": ["sex_at_birth", "ancestry"],
        "age_ancestry": ["age_group", "ancestry"],
    }
    joined = values.where(F.col(f"`{value}`").isNotNull()).join(
        demographics.select("person_id", *dims), "person_id"
    )
    # Distinct values with counts per full cell, before the six sets multiply the rows.
    cells = joined.groupBy(*dims, F.col(f"`{value}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    tagged = _grouped_by_sets(cells, sets, dims, {"__n": "n"}, ["v"])
    keys = ["breakdown", *dims]
    weight = F.col("__n")
    out = summarize_counts(
        tagged,
        keys,
        "v",
        [0.25, 0.5, 0.75],
        [
            F.sum(weight).alias("n"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
            (F.sum(F.col("v") * weight) / F.sum(weight)).alias("mean"),
        ],
        **limits,
    )
    return out.select(
        *keys,
        "n",
        "min",
        "max",
        "mean",
        F.col("pctl")[0].alias("q1"),
        F.col("pctl")[1].alias("median"),
        F.col("pctl")[2].alias("q3"),
    )
