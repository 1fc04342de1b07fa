"""Demographic, physical measurement, survey, procedure and cohort queries with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenomill.functions import scalar
from phenomill.operators import cohort, demographics, labs, survey
from phenomill.plans.queries_labs import SITE_FREE, clean
from phenomill.plans.queries_phecodes import WIDE, WIDE_SQL, wide
from phenomill.plans.registry import query, rounded
from phenomill.session import scratch_path, write_intermediate
from phenomill.sources import readers, sinks

PM = ["height", "weight", "waist-circumference-mean", "hip-circumference-mean"]


def pm_wide(t):
    return demographics.pivot_median(t.physical_measurement(), PM)


def covariates(t):
    return demographics.derive_covariates(
        demographics.filter_demographics(demographics.distinct_demographics(t.cb_search_person()))
    )


# --- demographics ---


@query("SELECT DISTINCT person_id, age_at_cdr, sex_at_birth FROM cb_search_person")
def distinct_demographics(t):
    return demographics.distinct_demographics(t.cb_search_person())


@query("SELECT person_id, age_at_cdr, age_group FROM demographics")
def age_group(t):
    return demographics.with_age_group(t.cb_search_person()).select("person_id", "age_at_cdr", "age_group")


@query("SELECT person_id, age_at_cdr FROM cb_search_person WHERE age_at_cdr IS NOT NULL AND sex_at_birth IS NOT NULL")
def drop_missing(t):
    return demographics.drop_missing(t.cb_search_person(), ["age_at_cdr", "sex_at_birth"]).select("person_id", "age_at_cdr")


@query("""SELECT person_id, age_at_cdr, sex_at_birth FROM cb_search_person
          WHERE age_at_cdr <= 100 AND sex_at_birth IN ('Female', 'Male')""")
def filter_demographics(t):
    return demographics.filter_demographics(t.cb_search_person()).select("person_id", "age_at_cdr", "sex_at_birth")


@query("SELECT person_id, age, age2, age_sex, age2_sex, sex FROM covariates")
def derive_covariates(t):
    return covariates(t)


# --- physical measurements ---


@query("""SELECT person_id, measurement_source_value, value_as_number FROM physical_measurement
          WHERE lower(measurement_source_value) IN ('height', 'weight', 'waist-circumference-mean', 'hip-circumference-mean')""")
def filter_source_values(t):
    return demographics.filter_source_values(t.physical_measurement(), PM)


@query("""SELECT person_id, height, weight, waist AS "waist-circumference-mean", hip AS "hip-circumference-mean" FROM pm_wide""")
def pivot_median(t):
    return pm_wide(t)


@query("SELECT person_id, round(height / 100, 6) AS height_m, round(bmi, 6) AS BMI, round(whr, 6) AS waist_hip_ratio FROM bmi")
def derive_bmi_whr(t):
    out = demographics.derive_bmi_whr(pm_wide(t)).select("person_id", "height_m", "BMI", "waist_hip_ratio")
    return rounded(out, "height_m", "BMI", "waist_hip_ratio")


@query("""
    WITH c AS (SELECT person_id, bmi AS b, whr AS w FROM bmi WHERE bmi IS NOT NULL AND whr IS NOT NULL),
         f AS (SELECT regr_slope(w, b) AS slope, regr_intercept(w, b) AS intercept FROM c)
    SELECT person_id, round(b, 6) AS BMI, round(w - (intercept + slope * b), 6) AS WHRadjBMI FROM c, f""")
def ols_residual(t):
    return rounded(demographics.bmi_whradjbmi(pm_wide(t)), "BMI", "WHRadjBMI")


def _continuous_sql() -> str:
    sets = [
        ("all", "NULL AS age_group, NULL AS sex_at_birth, NULL AS ancestry"),
        ("age", "age_group, NULL AS sex_at_birth, NULL AS ancestry"),
        ("sex", "NULL AS age_group, sex_at_birth, NULL AS ancestry"),
        ("ancestry", "NULL AS age_group, NULL AS sex_at_birth, ancestry"),
        ("sex_ancestry", "NULL AS age_group, sex_at_birth, ancestry"),
        ("age_ancestry", "age_group, NULL AS sex_at_birth, ancestry"),
    ]
    union = " UNION ALL ".join(f"SELECT '{n}' AS breakdown, {c}, height FROM v" for n, c in sets)
    return f"""
        WITH v AS (SELECT height, age_group, sex_at_birth, ancestry FROM pm_wide JOIN demographics USING (person_id)
                   WHERE height IS NOT NULL)
        SELECT breakdown, CAST(age_group AS VARCHAR) AS age_group, CAST(sex_at_birth AS VARCHAR) AS sex_at_birth,
               CAST(ancestry AS VARCHAR) AS ancestry, count(*) AS n, min(height) AS min, max(height) AS max,
               round(avg(height), 6) AS mean, round(quantile_cont(height, 0.25), 6) AS q1, round(median(height), 6) AS median,
               round(quantile_cont(height, 0.75), 6) AS q3
        FROM ({union}) GROUP BY ALL"""


@query(_continuous_sql())
def continuous_breakdown(t):
    people = demographics.with_age_group(t.cb_search_person())
    return rounded(demographics.continuous_breakdown(pm_wide(t), people, "height"), "mean", "q1", "median", "q3")


# --- surveys and procedures ---


@query("SELECT person_id, question_concept_id, answer FROM ds_survey WHERE survey = 'The Basics' AND question_concept_id = 105")
def filter_survey(t):
    out = survey.filter_survey(t.ds_survey(), "The Basics", 105)
    return out.select("person_id", "question_concept_id", "answer")


@query("""SELECT split_part(question, ': ', 1) AS topic, split_part(question, ': ', 2) AS question, question_concept_id,
                 count(DISTINCT person_id) AS N_participants
          FROM ds_survey WHERE survey = 'The Basics' GROUP BY ALL""")
def survey_question_counts(t):
    return survey.survey_question_counts(t.ds_survey())


@query("""SELECT answer, count(DISTINCT person_id) AS n, CAST(sum(count(DISTINCT person_id)) OVER () AS BIGINT) AS total
          FROM ds_survey GROUP BY answer""")
def share_of_total(t):
    return survey.share_of_total(t.ds_survey(), "answer")


ANSWERS = """
    WITH a AS (SELECT answer, n, round(100 * (n / sum(n) OVER ()), 2) AS pct
               FROM (SELECT answer, count(DISTINCT person_id) AS n FROM ds_survey WHERE question_concept_id = 105 GROUP BY answer))
    SELECT replace(answer, 'PMI: ', '') AS Answer, n AS N_participants, pct AS Percentage FROM a
    UNION ALL SELECT 'TOTAL', CAST(sum(n) AS BIGINT), round(sum(pct)) FROM a"""


@query(ANSWERS)
def answer_distribution(t):
    return survey.answer_distribution(t.ds_survey(), 105)


@query("""SELECT person_id, concept_name AS answer_name FROM (SELECT person_id, l_partkey, l_linenumber FROM lo) JOIN concept ON l_partkey = concept_id
          WHERE l_linenumber = 1""")
def observation_answers(t):
    observation = t.lo().select(
        "person_id",
        F.col("l_linenumber").alias("observation_concept_id"),
        F.col("l_partkey").alias("value_source_concept_id"),
    )
    return survey.observation_answers(observation, t.concept(), 1, "answer_name")


RECODED = {"Female": "F", "Male": "M", "Other": ""}


@query("""SELECT person_id, CASE sex_at_birth WHEN 'Female' THEN 'F' WHEN 'Male' THEN 'M' ELSE sex_at_birth END AS sex_at_birth
          FROM cb_search_person""")
def recode_values(t):
    return survey.recode_values(t.cb_search_person(), "sex_at_birth", RECODED).select("person_id", "sex_at_birth")


@query("""SELECT person_id, coalesce(bool_or(procedure_concept_id IN (4134857, 398010007)), FALSE) AS is_concept_4134857
          FROM procedure_occurrence FULL JOIN person USING (person_id) GROUP BY person_id""")
def join_procedure_status(t):
    return survey.join_procedure_status(t.procedure_occurrence(), t.person())


@query("""SELECT DISTINCT person_id, coalesce(procedure_concept_id IN (4134857, 398010007), FALSE) AS is_concept_4134857
          FROM procedure_occurrence FULL JOIN person USING (person_id)""")
def join_procedure_pairs(t):
    return survey.join_procedure_status(t.procedure_occurrence(), t.person(), one_row=False)


# --- cohort assembly ---


@query("SELECT person_id, age_at_cdr AS age FROM cb_search_person")
def rename_first_column(t):
    df = t.cb_search_person().select(F.col("person_id").alias("s"), F.col("age_at_cdr").alias("age"))
    return cohort.rename_first_column(df)


@query("""SELECT person_id, count(*) FILTER (l_linenumber = 1) AS phe_1, count(*) FILTER (l_linenumber = 2) AS phe_2
          FROM lo GROUP BY person_id""")
def rename_numeric_columns(t):
    wide = t.lo().groupBy("person_id").pivot("l_linenumber", [1, 2]).count().na.fill(0)
    return cohort.rename_numeric_columns(wide)


@query("SELECT sex, person_id, age FROM covariates")
def reorder_columns(t):
    return cohort.reorder_columns(covariates(t), ["sex", "person_id"]).select("sex", "person_id", "age")


WIDE_COLUMNS = ", ".join(f'"{code}"' for code in WIDE)


def scores_as_text(t, k: int = 20):
    """Scores in their exported text form: the first elements of each vector."""
    parts = F.transform(F.slice("embedding", 1, k), lambda x: F.format_string("%.6f", x.cast("double")))
    return t.raw("embeddings").select(
        F.col("vec_id").cast("string").alias("s"), F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]")).alias("scores")
    )


PCS = "SELECT vec_id AS person_id, " + ", ".join(
    f"CAST(format('{{:.6f}}', CAST(embedding[{i + 1}] AS DOUBLE)) AS DOUBLE) AS PC{i + 1}" for i in range(20)
) + " FROM embeddings"


@query(PCS)
def expand_scores_to_pcs(t):
    pcs = cohort.expand_scores_to_pcs(cohort.rename_first_column(scores_as_text(t)))
    return cohort.with_person_id(pcs)


@query("SELECT CAST(person_id AS VARCHAR) AS person_id, coalesce(CAST(age_at_cdr AS VARCHAR), '') AS age_at_cdr FROM cb_search_person")
def fill_missing_text(t):
    return cohort.fill_missing_text(t.cb_search_person().select("person_id", "age_at_cdr"))


@query("SELECT person_id, age, sex FROM covariates WHERE sex = 1")
def sex_specific_cohort(t):
    return cohort.sex_specific_cohort(covariates(t), "Female").select("person_id", "age", "sex")


@query("""SELECT person_id, age, n_orders FROM covariates
          LEFT JOIN (SELECT o_custkey AS person_id, count(*) AS n_orders FROM orders GROUP BY 1) USING (person_id)""")
def join_person_left(t):
    n_orders = t.raw("orders").groupBy(F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("person_id")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return cohort.join_person_left(covariates(t).select("person_id", "age"), n_orders)


ALL_PCS = ", ".join(f"PC{i + 1}" for i in range(20))


@query(f"SELECT person_id, age, sex, {ALL_PCS} FROM covariates JOIN ({PCS}) USING (person_id)")
def join_pcs_strict(t):
    pcs = cohort.expand_scores_to_pcs(cohort.rename_first_column(scores_as_text(t)))
    return cohort.join_pcs_strict(covariates(t).select("person_id", "age", "sex"), pcs)


@query(f"""SELECT CAST(person_id AS VARCHAR) AS person_id, CAST(age AS VARCHAR) AS age, CAST(sex AS VARCHAR) AS sex, {ALL_PCS}
           FROM covariates JOIN ({PCS}) USING (person_id) WHERE sex = 0""")
def combine_covariates_and_pcs(t):
    """The components, which come as text, are compared as numbers."""
    out = cohort.combine_covariates_and_pcs(covariates(t).select("person_id", "age", "sex"), scores_as_text(t), "Male")
    return out.withColumns({f"PC{i + 1}": F.col(f"PC{i + 1}").cast("double") for i in range(20)})


def median_by_lab(t):
    kept = labs.drop_sites_by_concept(clean(t), t.site_drops())
    medians = labs.person_median(kept, ["measurement_concept_id", "person_id"])
    return medians.select("person_id", F.col("measurement_concept_id").cast("string").alias("concept_key"), "median")


@query(f"""SELECT person_id, round(median(value_as_number) FILTER (measurement_concept_id = 1), 6) AS median_1,
                  round(median(value_as_number) FILTER (measurement_concept_id = 2), 6) AS median_2
           FROM ({SITE_FREE}) GROUP BY person_id""")
def scan_measurement_summaries(t):
    """Summary files with another header for each lab, read as one long table, then one column per lab."""
    path = scratch_path(t.spark, "summaries")
    medians = write_intermediate(median_by_lab(t), "medians")
    for key, columns in (("1", ["person_id", "median"]), ("2", ["concept_key", "median", "note", "person_id"])):
        rows = medians.where(F.col("concept_key") == key).withColumn("note", F.lit('a, "b"'))
        sinks.write_csv(rows.select(*columns), f"{path}/measurement_{key}_summary.csv")
    long = readers.scan_measurement_summaries(t.spark, path, r"measurement_([\d_]+)_summary\.csv/", "part-*")
    return rounded(cohort.medians_wide(long, ["1", "2"]), "median_1", "median_2")


@query(f"""SELECT person_id, age, age2, age_sex, age2_sex, sex, round(bmi.bmi, 6) AS BMI, round(whr, 6) AS waist_hip_ratio, height, weight,
                  waist AS "waist-circumference-mean", hip AS "hip-circumference-mean",
                  round(median_1, 6) AS median_1, round(median_2, 6) AS median_2, {WIDE_COLUMNS}
           FROM covariates FULL JOIN bmi USING (person_id)
           FULL JOIN (SELECT person_id, median(value_as_number) FILTER (measurement_concept_id = 1) AS median_1,
                             median(value_as_number) FILTER (measurement_concept_id = 2) AS median_2
                      FROM ({SITE_FREE}) GROUP BY person_id) USING (person_id)
           FULL JOIN ({WIDE_SQL}) USING (person_id)""")
def join_all_phenotypes(t):
    """All covariates, physical columns, labs and phecodes; the physical table is built once."""
    physical = write_intermediate(demographics.derive_bmi_whr(pm_wide(t)), "physical")
    out = cohort.join_all_phenotypes(
        {
            "demographics": covariates(t),
            "bmi": physical.select("person_id", "BMI", "waist_hip_ratio"),
            "physical": physical.select("person_id", "height", "weight", "`waist-circumference-mean`", "`hip-circumference-mean`"),
            "labs": cohort.medians_wide(median_by_lab(t), ["1", "2"]),
            "phecodes": wide(t),
        }
    )
    return rounded(out, "BMI", "waist_hip_ratio", "median_1", "median_2")


ANCESTRIES = "SELECT c_mktsegment AS ancestry, vec_id AS s, c_acctbal / 10000 AS prob FROM embeddings JOIN customer ON vec_id = c_custkey"


@query(f"SELECT ancestry, s FROM ({ANCESTRIES}) WHERE prob > 0.75 AND s NOT IN (SELECT s FROM flagged)")
def ancestry_cohorts(t):
    samples = t.raw("embeddings").select(F.col("vec_id").alias("s"))
    customer = t.raw("customer")
    ancestry = samples.join(customer, samples["s"] == customer["c_custkey"]).select(
        F.col("c_mktsegment").alias("ancestry"), "s", (F.col("c_acctbal") / 10000).alias("prob")
    )
    return cohort.ancestry_cohorts(ancestry, t.flagged_samples(), samples)


@query("SELECT s, marker_id, dosage FROM genotypes WHERE s IN (SELECT s FROM flagged)")
def semi_join_samples(t):
    return cohort.semi_join_samples(t.genotypes(), t.flagged_samples()).select("s", "marker_id", "dosage")


@query("SELECT s, marker_id, dosage FROM genotypes WHERE s NOT IN (SELECT s FROM flagged)")
def anti_join_samples(t):
    return cohort.anti_join_samples(t.genotypes(), t.flagged_samples()).select("s", "marker_id", "dosage")


@query("SELECT s FROM flagged")
def scan_sample_list(t):
    path = scratch_path(t.spark, "samples")
    sinks.write_tsv(t.flagged_samples(), path)
    return readers.scan_sample_list(t.spark, path).select(scalar.normalize_person_id(F.col("s")).alias("s"))


@query("SELECT CAST(person_id AS VARCHAR) AS person_id, CAST(age AS VARCHAR) AS age, CAST(sex AS VARCHAR) AS sex FROM covariates")
def scan_delimited(t):
    path = scratch_path(t.spark, "covariates")
    sinks.write_csv(covariates(t).select("person_id", "age", "sex"), path)
    return readers.scan_delimited(t.spark, path)


@query("SELECT person_id, age, age2, sex FROM covariates ORDER BY age DESC, person_id LIMIT 3")
def preview(t):
    return cohort.preview(covariates(t).select("person_id", "age", "age2", "sex"), [F.desc("age"), "person_id"], 3)
