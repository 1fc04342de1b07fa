"""Diagnosis code queries with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenomill.operators import correlation, demographics, phecodes
from phenomill.plans.registry import query, rounded
from phenomill.session import scratch_path
from phenomill.sources import readers, sinks

# Columns of the wide table: every code of the data, the five parents and their 25 children (brands 11 to 55).
WIDE = [f"GR_{i}" for i in range(5)] + [f"GR_{n % 5}.{n}" for n in (10 * a + b for a in range(1, 6) for b in range(1, 6))]


def expanded(t):
    return phecodes.expand_rollup(t.code_map(), t.rollup())


def counts(t):
    return phecodes.code_counts(phecodes.icd_events(t.icd_branches(), t.concept()), expanded(t))


def status(t):
    return phecodes.phecode_status(
        counts(t), t.population(), phecodes.person_sex(t.person()), t.restrictions()
    )


@query("SELECT concept_id, vocabulary_id FROM concept WHERE vocabulary_id IN ('ICD9CM', 'ICD10CM')")
def filter_vocabulary(t):
    return phecodes.filter_vocabulary(t.concept()).select("concept_id", "vocabulary_id")


@query("""SELECT person_id, concept_id AS source_concept_id, concept_name, vocabulary_id
          FROM lo JOIN concept ON l_partkey = concept_id""")
def join_concept_inner(t):
    events = t.lo().select("person_id", F.col("l_partkey").alias("source_concept_id"))
    return phecodes.join_concept_inner(events, t.concept(), "source_concept_id").select(
        "person_id", "source_concept_id", "concept_name", "vocabulary_id"
    )


@query("SELECT person_id, vocabulary_id, concept_code, date FROM icd_codes")
def union_icd_codes(t):
    return phecodes.union_icd_codes(t.icd_branches(), t.concept())


@query("SELECT vocabulary_id, concept_code, phecode FROM expanded_map")
def expand_rollup(t):
    return expanded(t)


@query("SELECT vocabulary_id, concept_code, phecode FROM expanded_map")
def scan_external_mapping(t):
    path = scratch_path(t.spark, "expanded_map")
    sinks.write_csv(expanded(t), path)
    return readers.scan_external_mapping(t.spark, path)


@query("SELECT person_id, vocabulary_id, concept_code, date, phecode FROM icd_codes JOIN expanded_map USING (vocabulary_id, concept_code)")
def join_code_map(t):
    return phecodes.join_code_map(phecodes.union_icd_codes(t.icd_branches(), t.concept()), expanded(t))


@query("SELECT person_id, phecode, code_count FROM code_counts")
def code_counts(t):
    return counts(t)


@query("SELECT DISTINCT person_id FROM cb_search_person WHERE has_ehr_data = 1")
def filter_ehr_participants(t):
    return phecodes.filter_ehr_participants(t.cb_search_person())


@query("SELECT n_site, count(*) AS n FROM (SELECT person_id, count(*) AS n_site FROM lo GROUP BY person_id) GROUP BY n_site")
def person_multiplicity(t):
    return phecodes.person_multiplicity(t.lo().select("person_id"))


@query("SELECT person_id, sex FROM person_sex")
def sex_code(t):
    return phecodes.person_sex(t.person())


@query("SELECT person_id FROM population WHERE person_id NOT IN (SELECT person_id FROM icd_codes)")
def missing_population(t):
    return phecodes.missing_population(t.population(), phecodes.icd_events(t.icd_branches(), t.concept()))


@query("SELECT person_id FROM population WHERE person_id NOT IN (SELECT person_id FROM icd_codes WHERE date < DATE '1993-01-01')")
def missing_population_early(t):
    """Persons without a code in the first years, of whom there are some."""
    events = phecodes.icd_events(t.icd_branches(), t.concept()).where("date < DATE '1993-01-01'")
    return phecodes.missing_population(t.population(), events)


@query("SELECT person_id, phecode, status FROM phecode_status")
def phecode_status(t):
    return status(t)


def _wide_sql() -> str:
    cells = []
    for code in WIDE:
        inner = (
            f"CASE WHEN max(code_count) FILTER (phecode = '{code}') >= 2 THEN TRUE "
            f"WHEN max(code_count) FILTER (phecode = '{code}') IS NULL THEN FALSE END"
        )
        only = {"GR_0": "F", "GR_1": "M"}.get(code)
        cells.append(f"CASE WHEN max(sex) = '{only}' THEN {inner} END AS \"{code}\"" if only else f'{inner} AS "{code}"')
    return (
        f"SELECT person_id, {', '.join(cells)} FROM population JOIN person_sex USING (person_id) "
        "LEFT JOIN code_counts USING (person_id) GROUP BY person_id"
    )


WIDE_SQL = _wide_sql()


def wide(t):
    return phecodes.phecode_wide(
        counts(t), t.population(), WIDE, phecodes.person_sex(t.person()), {"GR_0": "F", "GR_1": "M"}
    )


@query(WIDE_SQL)
def phecode_wide(t):
    return wide(t)


@query("SELECT phecode, count(*) FILTER (status) AS cases FROM phecode_status GROUP BY phecode")
def phecode_case_counts(t):
    return phecodes.phecode_case_counts(status(t))


def brand_pairs(t):
    """Each child code with its parent as a two-code phenotype."""
    parent = F.split("phecode", r"\.")[0]
    return t.code_map().select(
        F.concat(F.lit("P_"), "phecode").alias("phenotype_ID"), parent.alias("phecode_1"), F.col("phecode").alias("phecode_2")
    ).distinct()


PAIRS = "SELECT DISTINCT 'P_' || phecode AS phenotype_ID, split_part(phecode, '.', 1) AS phecode_1, phecode AS phecode_2 FROM code_map"
CASES = "SELECT phecode, count(*) FILTER (status) AS cases FROM phecode_status GROUP BY phecode"


@query(f"""SELECT phenotype_ID, phecode_1, phecode_2, a.cases AS cases_1, b.cases AS cases_2
           FROM ({PAIRS}) JOIN ({CASES}) a ON phecode_1 = a.phecode JOIN ({CASES}) b ON phecode_2 = b.phecode""")
def order_pairs(t):
    return phecodes.pair_case_counts(brand_pairs(t), status(t))


# Two-sided p-value of a correlation: the tail of its density, (1 - x^2)^((n - 4) / 2) with a constant, by Simpson's rule.
P_VALUE = """CASE WHEN r IS NOT NULL THEN round(least(1, greatest(0, 1 - 2 * exp(lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0)) / sqrt(pi()) * abs(r) / 18000
    * list_sum(list_transform(range(0, 6001), lambda i: (CASE WHEN i IN (0, 6000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                                                        * pow(greatest(0, 1 - r * r * i * i / 36000000.0), (n - 4) / 2.0))))), 6) END"""


@query(f"""WITH c AS (SELECT corr(a.cases, b.cases) AS r, count(*) AS n
                      FROM ({PAIRS}) JOIN ({CASES}) a ON phecode_1 = a.phecode JOIN ({CASES}) b ON phecode_2 = b.phecode)
           SELECT round(r, 6) AS r, n, {P_VALUE} AS p_value FROM c""")
def pearson_corr(t):
    pairs = phecodes.pair_case_counts(brand_pairs(t), status(t))
    return rounded(correlation.pearson_corr(pairs, "cases_1", "cases_2"), "r", "p_value")


@query(f"""
    WITH flags AS (SELECT phenotype_ID, phecode_1, phecode_2, p.person_id,
                          max(CASE WHEN s.status AND s.phecode = phecode_1 THEN 1 ELSE 0 END) AS a,
                          max(CASE WHEN s.status AND s.phecode = phecode_2 THEN 1 ELSE 0 END) AS b
                   FROM ({PAIRS}), population p LEFT JOIN phecode_status s ON p.person_id = s.person_id
                   GROUP BY ALL),
         c AS (SELECT phenotype_ID, phecode_1, phecode_2, CAST(sum(a) AS BIGINT) AS cases_1, CAST(sum(b) AS BIGINT) AS cases_2,
                      CAST(sum(a * b) AS BIGINT) AS both, count(*) AS n, CASE WHEN NOT isnan(corr(a, b)) THEN corr(a, b) END AS r
               FROM flags GROUP BY ALL HAVING sum(a + b) > 0)
    SELECT phenotype_ID, phecode_1, phecode_2, cases_1, cases_2, c."both", n, round(r, 6) AS r, {P_VALUE} AS p_value FROM c""")
def phecode_pair_corr(t):
    out = correlation.phecode_pair_corr(brand_pairs(t), status(t), t.population())
    return rounded(out, "r", "p_value")


def people(t):
    return demographics.with_age_group(t.cb_search_person()).where("has_ehr_data = 1")


def _breakdown_sql() -> str:
    sets = [
        ("age", "age_group, NULL AS sex_at_birth, NULL AS ancestry"),
        ("sex", "NULL AS age_group, sex_at_birth, NULL AS ancestry"),
        ("ancestry", "NULL AS age_group, NULL AS sex_at_birth, ancestry"),
        ("sex_ancestry", "NULL AS age_group, sex_at_birth, ancestry"),
        ("age_ancestry", "age_group, NULL AS sex_at_birth, ancestry"),
    ]
    union = " UNION ALL ".join(
        f"SELECT phecode, '{name}' AS breakdown, {columns}, case_, control FROM cells" for name, columns in sets
    )
    return f"""
        WITH cells AS (
            SELECT c.phecode, d.age_group, d.sex_at_birth, d.ancestry,
                   CASE WHEN s.status THEN 1 ELSE 0 END AS case_,
                   CASE WHEN s.person_id IS NULL THEN 1 ELSE 0 END AS control
            FROM (SELECT DISTINCT phecode FROM phecode_status) c
            CROSS JOIN (SELECT * FROM demographics WHERE has_ehr_data = 1) d
            LEFT JOIN phecode_status s ON s.person_id = d.person_id AND s.phecode = c.phecode)
        SELECT phecode, breakdown, age_group, sex_at_birth, ancestry, CAST(sum(case_) AS BIGINT) AS cases,
               CAST(sum(control) AS BIGINT) AS controls
        FROM ({union}) GROUP BY phecode, breakdown, age_group, sex_at_birth, ancestry"""


@query(_breakdown_sql())
def case_control_breakdown(t):
    return phecodes.case_control_breakdown(status(t), people(t))
