"""Lab queries with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenomill.operators import labs
from phenomill.plans.adapters import Tables
from phenomill.plans.registry import query, rounded
from phenomill.sources import readers


def harmonized(t: Tables, renaming: bool = False):
    unit_map = t.renaming_unit_map() if renaming else t.unit_map()
    return labs.harmonize(
        labs.project_contract(t.measurement()), t.metadata(), unit_map, t.unit_factors()
    )


def clean(t: Tables):
    return labs.trim(harmonized(t), keep=["measurement_concept_id"])


@query("SELECT sex_at_birth, count(*) AS n, count(age_at_cdr) AS with_age FROM cb_search_person GROUP BY sex_at_birth")
def scan_omop(t):
    return readers.sql_query(
        t.spark,
        "SELECT sex_at_birth, count(*) AS n, count(age_at_cdr) AS with_age FROM cb_search_person GROUP BY sex_at_birth",
        {"cb_search_person": t.cb_search_person()},
    )


EXTRACT = """
    SELECT DISTINCT person_id, measurement_concept_id, src_id, measurement_datetime,
           cm.concept_name AS standard_concept_name, cm.concept_code AS standard_concept_code,
           cm.vocabulary_id AS standard_vocabulary, u.concept_name AS unit_concept_name, value_as_number,
           co.concept_name AS operator_concept_name, unit_concept_id, value_as_concept_id,
           lower(cv.concept_name) AS value_as_concept_name, operator_concept_id, measurement_source_concept_id,
           lower(measurement_source_value) AS measurement_source_value, lower(unit_source_value) AS unit_source_value
    FROM omop_measurement JOIN measurement_ext USING (measurement_id)
    LEFT JOIN concept cm ON cm.concept_id = measurement_concept_id
    LEFT JOIN concept co ON co.concept_id = operator_concept_id
    LEFT JOIN concept u ON u.concept_id = unit_concept_id
    LEFT JOIN concept cv ON cv.concept_id = value_as_concept_id
    WHERE measurement_concept_id IN (1, 2)"""


@query(EXTRACT)
def scan_measurements(t):
    return labs.scan_measurements(t.omop_measurement(), t.measurement_ext(), t.concept(), [1, 2])


@query("""SELECT measurement_id, person_id, src_id, value_as_number
          FROM omop_measurement JOIN measurement_ext USING (measurement_id)""")
def join_fact_ext(t):
    return labs.join_fact_ext(t.omop_measurement(), t.measurement_ext()).select(
        "measurement_id", "person_id", "src_id", "value_as_number"
    )


@query("""SELECT measurement_id, cm.concept_name AS standard_concept_name, u.concept_name AS unit_concept_name,
                 co.concept_name AS operator_concept_name, cv.concept_name AS value_as_concept_name
          FROM omop_measurement
          LEFT JOIN concept cm ON cm.concept_id = measurement_concept_id
          LEFT JOIN concept co ON co.concept_id = operator_concept_id
          LEFT JOIN concept u ON u.concept_id = unit_concept_id
          LEFT JOIN concept cv ON cv.concept_id = value_as_concept_id""")
def join_concept_roles(t):
    return labs.join_concept_roles(t.omop_measurement(), t.concept()).select(
        "measurement_id",
        "standard_concept_name",
        "unit_concept_name",
        "operator_concept_name",
        "value_as_concept_name",
    )


@query("SELECT person_id, procedure_concept_id FROM procedure_occurrence WHERE procedure_concept_id IN (4134857, 398010007)")
def filter_concepts(t):
    return labs.filter_concepts(t.procedure_occurrence(), [4134857, 398010007], "procedure_concept_id")


@query("""SELECT person_id, measurement_concept_id, src_id, measurement_datetime, standard_concept_name,
                 standard_concept_code, standard_vocabulary, unit_concept_name, value_as_number, operator_concept_name
          FROM measurement""")
def project_contract(t):
    return labs.project_contract(t.measurement().withColumn("extra", F.lit(1)))


@query("SELECT person_id, measurement_concept_id, lab_name, standard_unit, value_as_number, minimum_value, maximum_value FROM with_lab")
def join_metadata(t):
    return labs.join_metadata(t.measurement(), t.metadata()).select(
        "person_id", "measurement_concept_id", "lab_name", "standard_unit", "value_as_number", "minimum_value", "maximum_value"
    )


@query("SELECT person_id, unit_concept_name, assigned_unit, unit_rename_flag FROM assigned", unit_map="renaming_unit_map")
def assign_unit(t):
    df = labs.join_metadata(t.measurement(), t.metadata())
    return labs.assign_unit(df, t.renaming_unit_map()).select(
        "person_id", "unit_concept_name", "assigned_unit", "unit_rename_flag"
    )


@query("SELECT person_id, assigned_unit, assigned_unit AS classified_unit FROM assigned")
def classify_unit(t):
    df = labs.assign_unit(labs.join_metadata(t.measurement(), t.metadata()), t.unit_map())
    return labs.classify_unit(df).select("person_id", "assigned_unit", "classified_unit")


@query("SELECT person_id, lab_name, assigned_unit AS classified_unit, standard_unit, conversion_factor FROM converted")
def join_unit_factors(t):
    df = labs.assign_unit(labs.join_metadata(t.measurement(), t.metadata()), t.unit_map())
    return labs.join_unit_factors(labs.classify_unit(df), t.unit_factors()).select(
        "person_id", "lab_name", "classified_unit", "standard_unit", "conversion_factor"
    )


@query("""SELECT person_id, unedited_value_as_number, round(value_c, 6) AS value_as_number, final_unit, conversion_factor
          FROM converted""")
def convert_unit(t):
    df = labs.assign_unit(labs.join_metadata(t.measurement(), t.metadata()), t.unit_map())
    out = labs.convert_unit(labs.classify_unit(df), t.unit_factors())
    return rounded(
        out.select("person_id", "unedited_value_as_number", "value_as_number", "final_unit", "conversion_factor"),
        "value_as_number",
    )


FLAGS = [
    "nan_flag",
    "nan_equiv_flag",
    "missing_value_flag",
    "unit_none_flag",
    "unit_rename_flag",
    "unit_discord_flag",
    "outlier_flag",
]


@query(
    f"SELECT person_id, round(value_as_number, 6) AS value_as_number, {', '.join(FLAGS)} FROM harmonized",
    unit_map="renaming_unit_map",
)
def flag_measurements(t):
    return rounded(harmonized(t, renaming=True).select("person_id", "value_as_number", *FLAGS), "value_as_number")


@query(f"""SELECT person_id, measurement_concept_id, src_id, measurement_datetime, lab_name, assigned_unit, final_unit,
                  unedited_value_as_number, round(value_as_number, 6) AS value_as_number, {', '.join(FLAGS)}
           FROM harmonized""")
def harmonize(t):
    out = harmonized(t).select(
        "person_id", "measurement_concept_id", "src_id", "measurement_datetime", "lab_name", "assigned_unit",
        "final_unit", "unedited_value_as_number", "value_as_number", *FLAGS,
    )
    return rounded(out, "value_as_number")


@query("""SELECT src_id, person_id, standard_concept_name, measurement_datetime, lab_name,
                 round(value_as_number, 6) AS value_as_number, unit FROM clean""")
def trim(t):
    return rounded(labs.trim(harmonized(t)), "value_as_number")


@query("""SELECT m.measurement_concept_id, m.lab_name, count(*) AS n,
                 count(*) FILTER (value_as_number < minimum_value OR value_as_number > maximum_value) AS outside
          FROM (SELECT measurement_concept_id, lab_name, CASE lab_name WHEN 'lab1' THEN 5 ELSE minimum_value END AS minimum_value,
                       CASE lab_name WHEN 'lab1' THEN 20 ELSE maximum_value END AS maximum_value FROM metadata) m
          JOIN measurement USING (measurement_concept_id) GROUP BY ALL""")
def update_outlier_bounds(t):
    changed = labs.update_outlier_bounds(t.metadata(), "lab1", 5, 20)
    value = F.col("value_as_number")
    outside = (value < F.col("minimum_value")) | (value > F.col("maximum_value"))
    return (
        labs.join_metadata(t.measurement(), changed)
        .groupBy("measurement_concept_id", "lab_name")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(outside).alias("outside"))
    )


@query("""SELECT src_id, person_id, lab_name, round(value_as_number, 6) AS value_as_number FROM clean
          WHERE src_id NOT IN ('EHR site 25', 'EHR site 50')""")
def drop_sites(t):
    out = labs.drop_sites(clean(t), [25, "EHR site 50"])
    return rounded(out.select("src_id", "person_id", "lab_name", "value_as_number"), "value_as_number")


@query("SELECT count(value_as_number) AS dropped_values FROM clean WHERE src_id IN ('EHR site 25', 'EHR site 50')")
def dropped_value_count(t):
    return labs.dropped_value_count(clean(t), [25, "EHR site 50"])


SITE_FREE = """SELECT * FROM clean WHERE NOT (measurement_concept_id = 1 AND src_id IN ('EHR site 25', 'EHR site 50'))"""


@query(f"SELECT measurement_concept_id, src_id, person_id, round(value_as_number, 6) AS value_as_number FROM ({SITE_FREE})")
def drop_sites_by_concept(t):
    out = labs.drop_sites_by_concept(clean(t), t.site_drops())
    return rounded(out.select("measurement_concept_id", "src_id", "person_id", "value_as_number"), "value_as_number")


@query("""SELECT standard_concept_name, measurement_concept_id, count(*) AS measurement_count,
                 count(DISTINCT person_id) AS participant_count, count(DISTINCT src_id) AS site_count,
                 count(DISTINCT unit_concept_name) AS unit_count
          FROM measurement GROUP BY standard_concept_name, measurement_concept_id""")
def query_summary(t):
    return labs.query_summary(t.measurement())


UNIT_STATS = ["min", "median", "max", "mean", "std", "percentile_01", "percentile_10", "percentile_75", "percentile_99"]


@query("""
    WITH c AS (SELECT *, NOT missing_value_flag AND NOT outlier_flag AS ok FROM harmonized)
    SELECT assigned_unit, count(DISTINCT person_id) AS n_pids, count(DISTINCT src_id) AS n_ehr, count(*) AS total_meas,
           count(*) FILTER (missing_value_flag) AS missing, count(value_as_number) AS meas_avail,
           count(*) FILTER (outlier_flag) AS outliers, min(conversion_factor) AS conversion_factor,
           count(value_as_number) FILTER (ok) AS filtered_count, round(min(value_as_number) FILTER (ok), 6) AS min,
           round(median(value_as_number) FILTER (ok), 6) AS median, round(max(value_as_number) FILTER (ok), 6) AS max,
           round(avg(value_as_number) FILTER (ok), 6) AS mean, round(stddev_samp(value_as_number) FILTER (ok), 6) AS std,
           round(quantile_cont(value_as_number, 0.01) FILTER (ok), 6) AS percentile_01,
           round(quantile_cont(value_as_number, 0.10) FILTER (ok), 6) AS percentile_10,
           round(quantile_cont(value_as_number, 0.75) FILTER (ok), 6) AS percentile_75,
           round(quantile_cont(value_as_number, 0.99) FILTER (ok), 6) AS percentile_99
    FROM c GROUP BY assigned_unit""")
def units_dist(t):
    return rounded(labs.units_dist(harmonized(t)), *UNIT_STATS)


@query("""SELECT lab_name, round(quantile_cont(value_as_number, 0.01), 6) AS percentile_01,
                 round(quantile_cont(value_as_number, 0.5), 6) AS percentile_50,
                 round(quantile_cont(value_as_number, 0.99), 6) AS percentile_99
          FROM clean GROUP BY lab_name""")
def percentile_agg(t):
    out = labs.percentile_agg(clean(t), ["lab_name"], "value_as_number", [0.01, 0.5, 0.99])
    return rounded(out, "percentile_01", "percentile_50", "percentile_99")


@query("""SELECT lab_name, round(quantile_cont(value_as_number, 0.01), 6) AS percentile_01,
                 round(quantile_cont(value_as_number, 0.5), 6) AS percentile_50,
                 round(quantile_cont(value_as_number, 0.99), 6) AS percentile_99
          FROM clean GROUP BY lab_name""")
def percentile_agg_by_ranks(t):
    """The same with every group treated as a very large one."""
    limits = {"max_group_rows": 0, "max_map_values": 0}
    out = labs.percentile_agg(clean(t), ["lab_name"], "value_as_number", [0.01, 0.5, 0.99], **limits)
    return rounded(out, "percentile_01", "percentile_50", "percentile_99")


SUMMARY = """
    SELECT measurement_concept_id, person_id,
           CAST(trunc(round(min(value_as_number), 9)) AS BIGINT) AS min,
           CAST(trunc(round(median(value_as_number), 9)) AS BIGINT) AS median,
           CAST(trunc(round(max(value_as_number), 9)) AS BIGINT) AS max,
           CAST(trunc(round(avg(value_as_number), 9)) AS BIGINT) AS mean,
           count(*) AS count,
           CAST(trunc(round(arg_max(value_as_number, {'d': CAST(measurement_datetime AS DATE), 'v': value_as_number}), 9)) AS BIGINT) AS latest
    FROM (%s) GROUP BY measurement_concept_id, person_id"""


@query(SUMMARY % SITE_FREE)
def person_summary(t):
    kept = labs.drop_sites_by_concept(clean(t), t.site_drops())
    return labs.person_summary(kept, ["measurement_concept_id", "person_id"])


UNDATED = f"SELECT * REPLACE (CASE WHEN person_id % 3 = 0 OR src_id >= 'EHR site 5' THEN measurement_datetime END AS measurement_datetime) FROM ({SITE_FREE})"


@query((SUMMARY % UNDATED).replace("'v': value_as_number})", "'v': value_as_number}) FILTER (measurement_datetime IS NOT NULL)"))
def person_summary_undated(t):
    """Many values, and all of some persons, have no date."""
    kept = labs.drop_sites_by_concept(clean(t), t.site_drops())
    dated = (F.col("person_id") % 3 == 0) | (F.col("src_id") >= "EHR site 5")
    kept = kept.withColumn("measurement_datetime", F.when(dated, F.col("measurement_datetime")))
    return labs.person_summary(kept, ["measurement_concept_id", "person_id"])


@query("""SELECT person_id, round(arg_max(value_as_number, {'d': CAST(measurement_datetime AS DATE), 'v': value_as_number}), 6) AS latest
          FROM clean GROUP BY person_id""")
def latest_per_person(t):
    return rounded(labs.latest_per_person(clean(t)), "latest")


@query("SELECT DISTINCT assigned_unit FROM harmonized")
def sorted_units(t):
    return labs.sorted_units(harmonized(t))


@query("""SELECT lab_name, assigned_unit, person_id, round(value_as_number, 6) AS value_as_number FROM harmonized
          WHERE value_as_number BETWEEN 2 AND 40 AND NOT missing_value_flag AND lab_name = 'lab1' AND assigned_unit = 'A'""")
def filter_histogram_range(t):
    out = labs.filter_histogram_range(harmonized(t), low=2, high=40, lab_name="lab1", unit="A")
    return rounded(out.select("lab_name", "assigned_unit", "person_id", "value_as_number"), "value_as_number")


@query("""
    WITH v AS (SELECT lab_name, assigned_unit, value_as_number AS x FROM harmonized
               WHERE value_as_number BETWEEN 0 AND 10000000 AND NOT missing_value_flag),
         w AS (SELECT lab_name, assigned_unit, max(x) / 9 AS width FROM v GROUP BY ALL)
    SELECT lab_name, assigned_unit, CAST(least(floor(x / width), 8) AS BIGINT) AS bin,
           round(max(least(floor(x / width), 8) * width), 6) AS bin_start,
           round(max((least(floor(x / width), 8) + 1) * width), 6) AS bin_end, count(*) AS frequency
    FROM v JOIN w USING (lab_name, assigned_unit) GROUP BY ALL""")
def histogram(t):
    return rounded(labs.histogram(harmonized(t)), "bin_start", "bin_end")


@query("""
    WITH v AS (SELECT src_id, assigned_unit, value_as_number AS x FROM harmonized WHERE NOT missing_value_flag),
         q AS (SELECT src_id, assigned_unit, quantile_cont(x, 0.25) AS q1, median(x) AS med, quantile_cont(x, 0.75) AS q3
               FROM v GROUP BY ALL),
         f AS (SELECT v.*, q1, med, q3, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
               FROM v JOIN q USING (src_id, assigned_unit))
    SELECT src_id, assigned_unit, count(*) AS n, round(max(q1), 6) AS q1, round(max(med), 6) AS median, round(max(q3), 6) AS q3,
           round(min(x) FILTER (inside), 6) AS whisker_low, round(max(x) FILTER (inside), 6) AS whisker_high,
           count(*) FILTER (NOT inside) AS n_outliers, (SELECT max(x) > 10 * avg(x) FROM v) AS use_log
    FROM f GROUP BY src_id, assigned_unit""")
def boxplot_stats(t):
    out = labs.boxplot_stats(harmonized(t), "annotated", "assigned_unit")
    return rounded(out, "q1", "median", "q3", "whisker_low", "whisker_high")


# HbA1c style cleaning: A stands for the linear unit, R for an unusable one.
def _hba1c(t):
    name = F.when(F.col("unit_concept_name") == "A", "milligram per deciliter").when(
        F.col("unit_concept_name") == "R", "no value"
    ).otherwise(F.col("unit_concept_name"))
    return t.measurement().withColumn("unit_concept_name", name)


HBA1C = """
    SELECT person_id, u AS unit_concept_name, value_as_number,
           CASE WHEN u = 'milligram per deciliter' THEN (value_as_number + 46.7) / 28.7 ELSE value_as_number END AS converted
    FROM (SELECT *, CASE unit_concept_name WHEN 'A' THEN 'milligram per deciliter' WHEN 'R' THEN 'no value'
                    ELSE unit_concept_name END AS u FROM measurement)"""


@query(f"SELECT person_id, unit_concept_name, value_as_number FROM ({HBA1C}) WHERE unit_concept_name IS NULL OR unit_concept_name <> 'no value'")
def exclude_units(t):
    return labs.exclude_units(_hba1c(t)).select("person_id", "unit_concept_name", "value_as_number")


@query(f"SELECT person_id, unit_concept_name, round(converted, 6) AS value_as_number FROM ({HBA1C})")
def convert_linear_unit(t):
    out = labs.convert_linear_unit(_hba1c(t))
    return rounded(out.select("person_id", "unit_concept_name", "value_as_number"), "value_as_number")


@query(f"SELECT person_id, value_as_number FROM ({HBA1C}) WHERE value_as_number <= 50")
def filter_value_cap(t):
    return labs.filter_value_cap(_hba1c(t)).select("person_id", "value_as_number")


@query(f"""SELECT person_id, round(median(converted), 6) AS median FROM ({HBA1C})
           WHERE (unit_concept_name IS NULL OR unit_concept_name <> 'no value') AND converted <= 50 GROUP BY person_id""")
def person_median(t):
    kept = labs.filter_value_cap(labs.convert_linear_unit(labs.exclude_units(_hba1c(t))))
    return rounded(labs.person_median(kept), "median")
