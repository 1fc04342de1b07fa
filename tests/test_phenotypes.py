from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from phenomill.operators import catalogue, cohort, correlation, demographics, phecodes, survey

D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)


@pytest.fixture
def coded(frame):
    concept = frame(
        "concept_id bigint, concept_name string, concept_code string, vocabulary_id string",
        (1, "x", "I1", "ICD9CM"), (2, "y", "I2", "ICD10CM"), (3, "z", "S", "SNOMED"),
    )
    schema = "person_id bigint, source_concept_id bigint, date date"
    branches = [
        frame(schema, (1, 1, D1), (1, 1, D1), (2, 1, D1), (3, 2, D1)),
        frame(schema, (1, 1, D2), (9, 1, D1), (9, 1, D2)),
        frame(schema, (3, 2, D2), (4, 3, D1)),
        frame(schema, (1, 1, D1)),
    ]
    code_map = frame(
        "code string, vocabulary_id string, phecode string", ("I1", "ICD9CM", "BI_160.11"), ("I2", "ICD10CM", "MA_1")
    )
    rollup = frame(
        "code string, phecode_unrolled string",
        ("BI_160.11", "BI_160.11"), ("BI_160.11", "BI_160.1"), ("BI_160.11", "BI_160"), ("MA_1", "MA_1"),
    )
    expanded = phecodes.expand_rollup(code_map, rollup)
    counts = phecodes.code_counts(phecodes.icd_events(branches, concept), expanded)
    return branches, concept, expanded, counts


def test_same_date_counts_once_and_children_roll_up(coded):
    branches, concept, expanded, counts = coded
    assert expanded.count() == 4
    assert phecodes.union_icd_codes(branches, concept).count() == 7
    got = {(r.person_id, r.phecode): r.code_count for r in counts.collect()}
    assert got[(1, "BI_160")] == got[(1, "BI_160.1")] == got[(1, "BI_160.11")] == 2
    assert got[(2, "BI_160")] == 1 and got[(3, "MA_1")] == 2 and got[(9, "BI_160")] == 2
    assert not any(p == 4 for p, _ in got)


def test_status_three_values_and_sex(frame, coded):
    counts = coded[3]
    population = frame("person_id bigint", (1,), (2,), (3,), (4,))
    sex = frame("person_id bigint, sex string", (1, "F"), (2, "M"), (3, "F"), (4, "0"))
    restrictions = frame("phecode string, male_only boolean, female_only boolean", ("MA_1", True, False))
    got = {(r.person_id, r.phecode): r.status for r in phecodes.phecode_status(counts, population, sex, restrictions).collect()}
    assert got[(1, "BI_160")] is True and got[(2, "BI_160")] is None and got[(3, "MA_1")] is None
    assert not any(p == 9 for p, _ in got)
    wide = phecodes.phecode_wide(counts, population, ["BI_160", "MA_1", "XX"], sex, {"MA_1": "M"})
    rows = {r.person_id: tuple(r)[1:] for r in wide.collect()}
    assert rows == {1: (True, None, False), 2: (None, False, False), 3: (False, None, False), 4: (False, None, False)}
    cases = {r.phecode: r.cases for r in phecodes.phecode_case_counts(phecodes.phecode_status(counts, population)).collect()}
    assert cases == {"BI_160": 1, "BI_160.1": 1, "BI_160.11": 1, "MA_1": 1}
    assert [r.person_id for r in phecodes.missing_population(population, coded[3]).collect()] == [4]


def test_status_adds_up_to_the_population(frame, coded):
    counts = coded[3]
    population = frame("person_id bigint", *[(i,) for i in range(1, 9)])
    wide = phecodes.phecode_wide(counts, population, ["BI_160"])
    r = wide.agg(F.count_if("BI_160").alias("t"), F.count_if(~F.col("BI_160")).alias("f"), F.count_if(F.col("BI_160").isNull()).alias("n")).first()
    assert tuple(r) == (1, 6, 1)


def test_breakdown_keeps_cells_without_cases(frame):
    status = frame("person_id bigint, phecode string, status boolean", (1, "A", True), (2, "A", None), (1, "B", True))
    people = frame(
        "person_id bigint, age_group string, sex_at_birth string, ancestry string",
        (1, "18-29", "Female", "x"), (2, "18-29", "Male", "x"), (3, None, "Male", "y"),
    )
    rows = phecodes.case_control_breakdown(status, people).collect()
    got = {(r.phecode, r.breakdown, r.age_group, r.sex_at_birth, r.ancestry): (r.cases, r.controls) for r in rows}
    assert got[("A", "sex", None, "Female", None)] == (1, 0)
    assert got[("A", "sex", None, "Male", None)] == (0, 1)
    assert got[("B", "ancestry", None, None, "y")] == (0, 1)
    assert got[("A", "age_ancestry", None, None, "y")] == (0, 1)


def test_pair_correlation(frame):
    import numpy as np

    a, b = [1, 1, 0, 0, 1, 0, 0, 0], [1, 0, 0, 0, 1, 0, 1, 0]
    status = frame(
        "person_id bigint, phecode string, status boolean",
        *[(i, "A", True) for i, x in enumerate(a) if x], *[(i, "B", True) for i, x in enumerate(b) if x], (7, "B", None),
    )
    pairs = frame("phenotype_ID string, phecode_1 string, phecode_2 string", ("P", "A", "B"), ("Q", "A", "A"))
    population = frame("person_id bigint", *[(i,) for i in range(8)])
    rows = {r.phenotype_ID: r for r in correlation.phecode_pair_corr(pairs, status, population).collect()}
    assert rows["P"].r == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert 0 < rows["P"].p_value < 1 and rows["Q"].r == pytest.approx(1.0)


def test_demographics(frame):
    df = frame(
        "person_id bigint, age_at_cdr double, sex_at_birth string",
        (1, 40.7, "Female"), (2, 101.0, "Male"), (3, None, "Male"), (4, 100.0, "Male"), (5, 30.0, "Intersex"),
    )
    rows = {r.person_id: tuple(r)[1:] for r in demographics.derive_covariates(demographics.filter_demographics(df)).collect()}
    assert rows == {1: (40, 1600, 40, 1600, 1), 4: (100, 10000, 0, 0, 0)}


def test_physical_measurements(frame):
    df = frame(
        "person_id bigint, measurement_source_value string, value_as_number double",
        (1, "Height", 170.0), (1, "height", 180.0), (1, "height", 180.0), (1, "weight", 70.0), (1, "BMI", 1.0), (2, "weight", 50.0),
    )
    wide = {r.person_id: r for r in demographics.pivot_median(df, ["height", "weight", "heart-rate-mean"]).collect()}
    assert (wide[1].height, wide[1].weight, wide[1]["heart-rate-mean"], wide[2].height) == (175.0, 70.0, None, None)
    pm = frame(
        "person_id bigint, height double, weight double, `waist-circumference-mean` double, `hip-circumference-mean` double",
        (1, 200.0, 80.0, 90.0, 100.0), (2, 0.0, 80.0, 90.0, 0.0), (3, 100.0, 30.0, 80.0, 100.0), (4, 100.0, 40.0, 70.0, 100.0),
    )
    rows = {r.person_id: (r.BMI, r.waist_hip_ratio) for r in demographics.derive_bmi_whr(pm).collect()}
    assert rows[1] == (20.0, 0.9) and rows[2] == (None, None)
    residuals = demographics.bmi_whradjbmi(pm).collect()
    assert len(residuals) == 3 and sum(r.WHRadjBMI for r in residuals) == pytest.approx(0.0)


def test_survey(frame):
    df = frame(
        "person_id bigint, survey string, question string, question_concept_id bigint, answer string",
        *[(i, "The Basics", "Topic: q", 1, "PMI: Skip" if i == 0 else "Yes" if i < 3 else "No") for i in range(7)],
        (1, "The Basics", "Topic: q", 1, "Yes"), (1, "Other", "No colon", 2, "x"),
    )
    rows = [tuple(r) for r in survey.answer_distribution(df, 1).collect()]
    assert rows == [("No", 4, 57.14), ("Yes", 2, 28.57), ("Skip", 1, 14.29), ("TOTAL", 7, 100.0)]
    counts = [tuple(r) for r in survey.survey_question_counts(df).collect()]
    assert counts == [("Topic", "q", 1, 7)]
    loose = survey.survey_question_counts(df, "Other", strict=False).collect()
    assert tuple(loose[0]) == ("No colon", None, 2, 1)
    with pytest.raises(Exception):
        survey.survey_question_counts(df, "Other").collect()


def test_recode_and_procedures(frame):
    df = frame("a string", ("Sex At Birth: Male",), ("Sex At Birth: Intersex",), ("PMI: Skip",), ("new",), (None,))
    got = [r.a for r in survey.recode_values(df, "a", survey.SEX_ANSWER_CODES).collect()]
    assert got == ["M", "", "PMI: Skip", "new", None]
    procedures = frame("person_id bigint, procedure_concept_id bigint", (1, 4134857), (1, 5), (2, 5), (8, 398010007))
    persons = frame("person_id bigint", (1,), (2,), (3,))
    rows = sorted(map(tuple, survey.join_procedure_status(procedures, persons).collect()))
    assert rows == [(1, True), (2, False), (3, False), (8, True)]
    rows = sorted(map(tuple, survey.join_procedure_status(procedures, persons, one_row=False).collect()))
    assert rows == [(1, False), (1, True), (2, False), (3, False), (8, True)]


def test_cohort_assembly(frame):
    covariates = frame("person_id string, sex string, y string", (" 1 ", "0.0", "a"), ("2", "1.0", None), ("3", "1", "c"))
    pcs = frame("s string, scores string", ("1", "[0.1, 0.2]"), ("2 ", "[1e-3,-2]"), ("4", "[1,2]"))
    rows = [tuple(r) for r in cohort.combine_covariates_and_pcs(covariates, pcs, None, 2).orderBy("person_id").collect()]
    assert rows == [("1", "0.0", "a", "0.1", "0.2"), ("2", "1.0", "", "0.001", "-2.0")]
    assert cohort.combine_covariates_and_pcs(covariates, pcs, "Male", 2).count() == 1
    assert cohort.sex_specific_cohort(covariates, "Female").count() == 2
    assert cohort.sex_specific_cohort(covariates, "").count() == 3


def test_full_join_of_tables_with_clashing_names(frame):
    a = frame("person_id bigint, x int, v int", (1, 1, 10), (2, 2, 20))
    b = frame("person_id bigint, `waist-mean` double, v int", (2, 1.5, 21), (3, 2.5, 31))
    out = cohort.join_all_phenotypes({"a": a, "b": b})
    assert out.columns == ["person_id", "x", "v_a", "waist-mean", "v_b"]
    assert sorted(map(tuple, out.collect())) == [(1, 1, 10, None, None), (2, 2, 20, 1.5, 21), (3, None, None, 2.5, 31)]


def test_column_names(frame):
    df = frame("s string, `495` int, `p.value` double", ("1", 2, 0.5))
    assert cohort.rename_numeric_columns(df).columns == ["s", "phe_495", "p.value"]
    assert cohort.reorder_columns(cohort.rename_first_column(df), ["p.value", "person_id"]).columns == ["p.value", "person_id", "495"]


CATALOGUE = "phenotype_ID string, trait_type string, invnormalise string, tol double, sex_specific_run string, phecode string, ord int"


def test_catalogue(frame):
    df = frame(
        CATALOGUE,
        ("A", "binary", "FALSE", 0.02, "", "phe_495, RE_475", 1),
        ("B", "binary", "FALSE", 0.02, "Female", "427.21", 2),
        ("C", "quantitative", "TRUE", 0.2, "", "4134857", 3),
        ("D", "binary", "FALSE", 0.02, "", "NaN", 4),
        ("E", "binary", "FALSE", 0.02, "Male", None, 5),
        ("F", "binary", "FALSE", 0.02, "Male", "RE_475, x, y, z, w", 6),
    )
    codes = {r.phecode: r.phenotype_ID for r in catalogue.explode_phecodes(df).collect()}
    assert codes == {"phe_495": "A", "RE_475": "F", "427.21": "B", "4134857": "C", "x": "F", "y": "F", "z": "F", "w": "F"}
    assert [r.phecode_2 for r in catalogue.filter_two_phecode(df).collect()] == ["RE_475"]
    assert catalogue.filter_phenotype_codes(df, []).count() == 6
    assert [r.phecode for r in catalogue.sorted_phenotypes(df).collect()] == sorted(codes)
    grid = cohort.run_grid(catalogue.sorted_phenotypes(df), ["afr", "eur"], ["snp"], ["plof"])
    assert grid.count() == 16
    crosswalk = frame("source_code string, target_code string, ord int", ("A", "old", 1), ("A", "new", 2))
    attached = {r.phenotype_ID: r.phecode for r in catalogue.attach_codes(df, crosswalk).collect()}
    assert attached["A"] == "new" and attached["B"] == "427.21"
