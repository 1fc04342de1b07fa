"""The adapters of ``adapters.py`` and the shared steps as plain SQL, for the oracle."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "lo": "SELECT l.*, o_custkey AS person_id FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey",
    "person": """
        SELECT c_custkey AS person_id,
               CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 WHEN c_custkey % 5 IN (1, 3) THEN 45878463
                    ELSE 45880669 END AS BIGINT) AS sex_at_birth_concept_id
        FROM customer""",
    "cb_search_person": """
        SELECT c_custkey AS person_id,
               CASE WHEN c_custkey % 41 <> 0 THEN 18 + (c_custkey * 7) % 90 END AS age_at_cdr,
               CASE WHEN c_custkey % 5 = 0 THEN 'Unknown' WHEN c_custkey % 5 IN (1, 3) THEN 'Female'
                    ELSE 'Male' END AS sex_at_birth,
               CASE WHEN c_custkey % 10 < 8 THEN 1 ELSE 0 END AS has_ehr_data,
               c_mktsegment AS ancestry
        FROM customer""",
    "population": "SELECT DISTINCT person_id FROM cb_search_person WHERE has_ehr_data = 1",
    "demographics": """
        SELECT *, CASE WHEN age_at_cdr BETWEEN 0 AND 29 THEN '18-29' WHEN age_at_cdr <= 39 AND age_at_cdr > 29 THEN '30-39'
                  WHEN age_at_cdr <= 49 AND age_at_cdr > 39 THEN '40-49' WHEN age_at_cdr <= 59 AND age_at_cdr > 49 THEN '50-59'
                  WHEN age_at_cdr <= 69 AND age_at_cdr > 59 THEN '60-69' WHEN age_at_cdr <= 79 AND age_at_cdr > 69 THEN '70-79'
                  WHEN age_at_cdr <= 89 AND age_at_cdr > 79 THEN '80-89' WHEN age_at_cdr <= 200 AND age_at_cdr > 89 THEN '90+'
                  END AS age_group
        FROM cb_search_person""",
    "covariates": """
        SELECT person_id, age, age * age AS age2, age * sex AS age_sex, age * age * sex AS age2_sex, sex
        FROM (SELECT person_id, CAST(age_at_cdr AS BIGINT) AS age,
                     CAST(CASE WHEN sex_at_birth = 'Female' THEN 1 ELSE 0 END AS BIGINT) AS sex
              FROM cb_search_person
              WHERE age_at_cdr <= 100 AND sex_at_birth IN ('Female', 'Male'))""",
    "measurement": """
        SELECT person_id, CAST(1 + l_linenumber % 2 AS BIGINT) AS measurement_concept_id,
               'EHR site ' || l_suppkey AS src_id, l_shipdate AS measurement_datetime,
               'lab ' || (1 + l_linenumber % 2) AS standard_concept_name,
               'code ' || (1 + l_linenumber % 2) AS standard_concept_code,
               'LOINC' AS standard_vocabulary,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE l_returnflag END AS unit_concept_name,
               CASE WHEN l_quantity = 50 THEN CAST(10000000 AS DOUBLE) ELSE l_quantity END AS value_as_number,
               CAST(NULL AS VARCHAR) AS operator_concept_name
        FROM lo""",
    "metadata": """
        SELECT CAST(c AS BIGINT) AS measurement_concept_id, 'lab' || c AS lab_name,
               'A' AS standard_unit, CAST(1 AS DOUBLE) AS minimum_value, CAST(45 AS DOUBLE) AS maximum_value
        FROM (VALUES (1), (2)) v(c)""",
    "unit_map": "SELECT CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS mapped WHERE 1 = 0",
    "renaming_unit_map": "SELECT * FROM (VALUES ('R', 'A'), ('N', NULL)) v(raw, mapped)",
    "unit_factors": """
        SELECT lab_name, u AS classified_unit, 'A' AS standard_unit, CAST(f AS DOUBLE) AS conversion_factor
        FROM (VALUES ('lab1'), ('lab2')) l(lab_name), (VALUES ('A', 1.0), ('N', 0.1), ('R', 0.0)) t(u, f)""",
    "with_lab": "SELECT m.*, lab_name, standard_unit, minimum_value, maximum_value FROM measurement m JOIN metadata USING (measurement_concept_id)",
    "assigned": """
        SELECT w.*, COALESCE(CASE WHEN raw IS NOT NULL THEN mapped ELSE unit_concept_name END, 'none') AS assigned_unit,
               raw IS NOT NULL AS unit_rename_flag
        FROM with_lab w LEFT JOIN unit_map ON unit_concept_name = raw""",
    "converted": """
        SELECT a.*, assigned_unit AS classified_unit, conversion_factor,
               a.value_as_number AS unedited_value_as_number,
               CASE WHEN conversion_factor = 0 THEN assigned_unit ELSE a.standard_unit END AS final_unit,
               CASE WHEN conversion_factor = 0 THEN a.value_as_number
                    ELSE a.value_as_number * conversion_factor END AS value_c
        FROM assigned a LEFT JOIN unit_factors f
          ON a.lab_name = f.lab_name AND a.assigned_unit = f.classified_unit AND a.standard_unit = f.standard_unit""",
    "harmonized": """
        SELECT * EXCLUDE (value_as_number, value_c), value_c AS value_as_number,
               value_c IS NULL AS nan_flag,
               COALESCE(value_c IN (10000000, 100000000), FALSE) AS nan_equiv_flag,
               value_c IS NULL OR value_c IN (10000000, 100000000) AS missing_value_flag,
               assigned_unit = 'none' AS unit_none_flag,
               COALESCE(final_unit <> standard_unit, TRUE) AS unit_discord_flag,
               COALESCE(value_c < minimum_value OR value_c > maximum_value, FALSE) AS outlier_flag
        FROM converted""",
    "clean": """
        SELECT measurement_concept_id, src_id, person_id, standard_concept_name, measurement_datetime, lab_name,
               value_as_number, final_unit AS unit
        FROM harmonized
        WHERE NOT nan_flag AND NOT nan_equiv_flag AND NOT unit_discord_flag AND NOT outlier_flag""",
    "omop_measurement": """
        SELECT l_orderkey * 10 + l_linenumber AS measurement_id, person_id,
               CAST(1 + l_linenumber % 2 AS BIGINT) AS measurement_concept_id, l_shipdate AS measurement_datetime,
               l_quantity AS value_as_number, CASE WHEN l_partkey % 3 = 0 THEN l_partkey END AS value_as_concept_id,
               CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL WHEN l_returnflag = 'A' THEN 3
                    WHEN l_returnflag = 'N' THEN 4 ELSE 5 END AS BIGINT) AS unit_concept_id,
               CAST(CASE WHEN l_suppkey % 2 = 0 THEN 6 END AS BIGINT) AS operator_concept_id,
               l_partkey AS measurement_source_concept_id, 'SRC ' || l_returnflag AS measurement_source_value,
               l_linestatus AS unit_source_value
        FROM lo""",
    "measurement_ext": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS measurement_id, 'EHR site ' || (l_orderkey % 100) AS src_id
        FROM lineitem""",
    "concept": """
        SELECT p_partkey AS concept_id, p_name AS concept_name, p_brand AS concept_code,
               CASE p_type WHEN 'STANDARD' THEN 'ICD9CM' WHEN 'PROMO' THEN 'ICD10CM' ELSE 'SNOMED' END AS vocabulary_id
        FROM part""",
    "icd_codes": """
        SELECT DISTINCT person_id, vocabulary_id, concept_code, CAST(l_shipdate AS DATE) AS date
        FROM lo JOIN concept ON l_partkey = concept_id WHERE vocabulary_id IN ('ICD9CM', 'ICD10CM')""",
    "code_map": """
        SELECT DISTINCT p_brand AS code, vocabulary_id,
               'GR_' || (CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) % 5) || '.' ||
               CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS phecode
        FROM part, (VALUES ('ICD9CM'), ('ICD10CM')) v(vocabulary_id)""",
    "rollup": """
        SELECT DISTINCT phecode AS code, phecode AS phecode_unrolled FROM code_map
        UNION SELECT DISTINCT phecode, split_part(phecode, '.', 1) FROM code_map""",
    "expanded_map": """
        SELECT DISTINCT m.vocabulary_id, m.code AS concept_code, r.phecode_unrolled AS phecode
        FROM code_map m JOIN rollup r ON m.phecode = r.code""",
    "code_counts": """
        SELECT person_id, phecode, COUNT(DISTINCT date) AS code_count
        FROM icd_codes JOIN expanded_map USING (vocabulary_id, concept_code) GROUP BY person_id, phecode""",
    "person_sex": """
        SELECT person_id, CASE sex_at_birth_concept_id WHEN 45878463 THEN 'F' WHEN 45880669 THEN 'M' ELSE '0' END AS sex
        FROM person""",
    "phecode_status": """
        SELECT person_id, phecode,
               CASE WHEN phecode = 'GR_0' AND sex <> 'F' THEN NULL WHEN phecode = 'GR_1' AND sex <> 'M' THEN NULL
                    WHEN code_count >= 2 THEN TRUE END AS status
        FROM code_counts JOIN population USING (person_id) JOIN person_sex USING (person_id)""",
    "ds_survey": """
        SELECT user_id AS person_id, CASE WHEN event_id % 10 < 9 THEN 'The Basics' ELSE 'Lifestyle' END AS survey,
               'Topic' || (event_id % 3) || ': ' || event_type AS question,
               CAST(100 * (event_id % 3) + list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS BIGINT)
                 AS question_concept_id,
               'PMI: ' || (event_id % 7) AS answer
        FROM events""",
    "physical_measurement": """
        SELECT person_id, CASE l_linenumber WHEN 1 THEN 'Height' WHEN 2 THEN 'weight' WHEN 3 THEN 'waist-circumference-mean'
               WHEN 4 THEN 'hip-circumference-mean' ELSE 'other' END AS measurement_source_value,
               100 + l_quantity AS value_as_number
        FROM lo""",
    "pm_wide": """
        SELECT person_id,
               median(v) FILTER (src = 'height') AS height, median(v) FILTER (src = 'weight') AS weight,
               median(v) FILTER (src = 'waist-circumference-mean') AS waist,
               median(v) FILTER (src = 'hip-circumference-mean') AS hip
        FROM (SELECT DISTINCT person_id, lower(measurement_source_value) AS src, value_as_number AS v
              FROM physical_measurement WHERE lower(measurement_source_value) IN
                ('height', 'weight', 'waist-circumference-mean', 'hip-circumference-mean'))
        GROUP BY person_id""",
    "bmi": """
        SELECT person_id, height, weight, waist, hip, weight / ((height / 100) * (height / 100)) AS bmi,
               waist / hip AS whr FROM pm_wide""",
    "procedure_occurrence": """
        SELECT person_id, CASE WHEN l_partkey % 97 = 0 THEN 4134857 ELSE l_partkey END AS procedure_concept_id FROM lo""",
    "association_results": """
        SELECT p_name || ' ' || p_partkey AS MarkerID, 'anc' || r_regionkey AS Ancestry, p_type AS Trait,
               p_brand AS VariantClass, CAST(p_size AS DOUBLE) AS AC_Allele2, (p_partkey % 100) / 100.0 AS AF_Allele2,
               CAST(pow(CAST(10 AS DOUBLE), -((p_partkey * 13 + r_regionkey) % 12)) AS DOUBLE) / (1 + p_partkey % 9) AS "p.value",
               CASE WHEN p_type IN ('STANDARD', 'PROMO', 'SMALL') THEN CAST(50 + p_partkey % 400 AS DOUBLE) END AS N_case,
               p_type IN ('STANDARD', 'PROMO', 'SMALL') AS has_n_case
        FROM part, region""",
    "filtered_results": """
        SELECT * FROM association_results
        WHERE AC_Allele2 >= 10 AND (NOT has_n_case OR N_case >= 100) AND AF_Allele2 < 0.5""",
    "catalogue": """
        SELECT 'P' || p_partkey AS phenotype_ID, p_name AS phenotype,
               CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Female' ELSE ' Male ' END AS sex_specific_run,
               CASE WHEN p_partkey % 4 = 0 THEN 'quantitative' ELSE 'binary' END AS trait_type,
               CASE WHEN p_partkey % 4 = 0 THEN 'TRUE' ELSE 'FALSE' END AS invnormalise,
               CAST(CASE WHEN p_partkey % 2 = 0 THEN 0.02 ELSE 0.2 END AS DOUBLE) AS tol,
               CASE p_partkey % 6
                 WHEN 0 THEN 'GR_' || (p_partkey % 5) || ', GR_' || (p_partkey % 5) || '.' || (p_partkey % 25)
                 WHEN 1 THEN (p_partkey % 300) || '.' || (p_partkey % 3)
                 WHEN 2 THEN CAST(4134857 + p_partkey % 50 AS VARCHAR)
                 WHEN 3 THEN 'NaN'
                 WHEN 4 THEN 'GR_' || (p_partkey % 5) || ', GR_' || (p_partkey % 5) || '.' || (p_partkey % 25) || ', ' ||
                             (p_partkey % 40) || ', RE_475, ' || p_type
               END AS phecode, p_partkey AS ord
        FROM part""",
    "catalogue_codes": """
        SELECT phecode, arg_max(phenotype_ID, ord) AS phenotype_ID, arg_max(trait_type, ord) AS trait_type,
               arg_max(invnormalise, ord) AS invnormalise, arg_max(tol, ord) AS tol,
               arg_max(sex_specific_run, ord) AS sex_specific_run
        FROM (SELECT trim(unnest(string_split(phecode, ','))) AS phecode, * EXCLUDE (phecode) FROM catalogue)
        WHERE phecode NOT IN ('', 'NaN') GROUP BY phecode""",
    "genotypes": """
        SELECT CAST(j // 32 + 1 AS BIGINT) AS chrom, CAST(1000 * j AS BIGINT) AS pos, 'm' || j AS marker_id, vec_id AS s,
               CASE WHEN (vec_id * 31 + j * 17) % 97 = 0 THEN NULL
                    WHEN b > CAST(0.02 AS DOUBLE) + CAST(0.005 AS DOUBLE) * j THEN 2
                    WHEN b > CAST(-0.1 AS DOUBLE) + CAST(0.005 AS DOUBLE) * j THEN 1 ELSE 0 END AS dosage
        FROM (SELECT vec_id, j, CAST(embedding[j - j % 4 + 1] AS DOUBLE)
                     + CAST(0.5 AS DOUBLE) * (j % 4) * CAST(embedding[j + 1] AS DOUBLE) AS b
              FROM embeddings, range(64) t(j))""",
    "flagged": "SELECT vec_id AS s FROM embeddings WHERE label = 0",
    "variants": """
        SELECT chrom, pos, marker_id, row_number() OVER (PARTITION BY chrom ORDER BY pos, marker_id) - 1 AS idx
        FROM (SELECT DISTINCT chrom, pos, marker_id FROM genotypes)""",
    "spread": """
        SELECT chrom, 60 * pos AS pos, marker_id, s, dosage FROM genotypes
        UNION ALL
        SELECT CAST(3 AS BIGINT), CAST(400000 * (k + 1) AS BIGINT), 'r' || k, vec_id, CASE WHEN vec_id BETWEEN 20 * k AND 21 * k + 9 THEN 1 ELSE 0 END
        FROM embeddings, range(8) t(k)""",
    "spread_variants": """
        SELECT chrom, pos, marker_id, row_number() OVER (PARTITION BY chrom ORDER BY pos, marker_id) - 1 AS idx
        FROM (SELECT DISTINCT chrom, pos, marker_id FROM spread)""",
    "spread_classes": """
        SELECT * FROM (SELECT *, CASE WHEN c2 - c1 BETWEEN 10 AND 19 OR c1 BETWEEN 10 AND 19 THEN 'rare'
                                      WHEN c1 >= 20 AND c2 - c1 >= 20 THEN 'common' END AS mac_class
                       FROM (SELECT marker_id, least(sum(dosage), 2 * count(dosage) - sum(dosage)) AS c1,
                                    greatest(sum(dosage), 2 * count(dosage) - sum(dosage)) AS c2 FROM spread GROUP BY marker_id))
        WHERE mac_class IS NOT NULL""",
    "af": "SELECT chrom, pos, marker_id, avg(dosage) / 2 AS af FROM genotypes GROUP BY ALL",
    "geno_counts": """
        SELECT chrom, pos, marker_id, count(*) FILTER (dosage = 0) AS hom_ref, count(*) FILTER (dosage = 1) AS het,
               count(*) FILTER (dosage = 2) AS hom_alt, count(*) FILTER (dosage IS NULL) AS missing
        FROM genotypes GROUP BY chrom, pos, marker_id""",
    "allele_counts": """
        SELECT chrom, pos, marker_id, alt_count, ref_count, least(alt_count, ref_count) AS c1,
               greatest(alt_count, ref_count) AS c2
        FROM (SELECT chrom, pos, marker_id, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS alt_count,
                     CAST(2 * count(dosage) - coalesce(sum(dosage), 0) AS BIGINT) AS ref_count
              FROM genotypes GROUP BY chrom, pos, marker_id)""",
    "mac_class": """
        SELECT * FROM (SELECT *, CASE WHEN c2 - c1 BETWEEN 10 AND 19 OR c1 BETWEEN 10 AND 19 THEN 'rare'
                                      WHEN c1 >= 20 AND c2 - c1 >= 20 THEN 'common' END AS mac_class FROM allele_counts)
        WHERE mac_class IS NOT NULL""",
    "loadings": """
        SELECT a.*, CAST(CAST(((pos // 1000) * 7) % 11 - 5 AS DOUBLE) / 10 AS DOUBLE) AS l0,
               CAST(CAST(((pos // 1000) * 5) % 13 - 6 AS DOUBLE) / 10 AS DOUBLE) AS l1
        FROM af a WHERE af > 0 AND af < 1""",
}



def with_views(body: str, **replaced: str) -> str:
    """Put the views that ``body`` uses in front of it, in order. ``replaced`` swaps a view for another
    of the list (``unit_map="renaming_unit_map"``)."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s*\(?{name}\b", sql):
                visit(definition(name))
                if name not in needed:
                    needed.append(name)

    def definition(name: str) -> str:
        return VIEWS[replaced.get(name, name)]

    visit(body)
    if not needed:
        return body
    views = ",\n".join(f"{n} AS ({definition(n).strip()})" for n in needed)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
