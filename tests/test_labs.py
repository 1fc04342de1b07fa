from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from phenomill.functions.nulls import nan_to_null
from phenomill.operators import labs

META = "measurement_concept_id bigint, lab_name string, standard_concept_name string, standard_unit string, minimum_value double, maximum_value double"
LAB = (
    "person_id bigint, measurement_concept_id bigint, src_id string, measurement_datetime timestamp, "
    "standard_concept_name string, standard_concept_code string, standard_vocabulary string, "
    "unit_concept_name string, value_as_number double, operator_concept_name string"
)


def lab_row(person, unit, value, site="EHR site 1", day=1):
    return (person, 1, site, dt.datetime(2020, 1, day), "name in data", "c", "v", unit, value, None)


@pytest.fixture
def tables(frame):
    return {
        "metadata": frame(META, (1, "lab", "other name", "g", 1.0, 100.0)),
        "unit_map": frame(
            "assigned_unit string, reduced_unit string, ord int",
            ("gram", "mg", 1), ("gram", "g", 2), ("blank", None, 3),
        ),
        "factors": frame(
            "lab_name string, assigned_unit string, standard_unit string, conversion_factor double",
            ("lab", "g", "g", 1.0), ("lab", "kg", "g", 1000.0), ("lab", "iu", "g", 0.0),
        ),
    }


def run(frame, tables, *rows, **options):
    df = nan_to_null(frame(LAB, *rows))
    return labs.harmonize(df, tables["metadata"], tables["unit_map"], tables["factors"], **options)


def one(df):
    return df.collect()[0]


def test_last_map_entry_wins_and_null_target_is_none(frame, tables):
    rows = {r.person_id: r for r in run(frame, tables, lab_row(1, "gram", 5.0), lab_row(2, "blank", 5.0)).collect()}
    assert (rows[1].assigned_unit, rows[1].unit_rename_flag) == ("g", True)
    assert (rows[2].assigned_unit, rows[2].unit_rename_flag, rows[2].unit_none_flag) == ("none", True, True)


def test_no_factor_gives_missing_value_and_standard_unit(frame, tables):
    r = one(run(frame, tables, lab_row(1, "lb", 5.0)))
    assert (r.value_as_number, r.unedited_value_as_number, r.final_unit) == (None, 5.0, "g")
    assert (r.nan_flag, r.unit_discord_flag, r.outlier_flag) == (True, False, False)


def test_factor_zero_keeps_value_and_unit(frame, tables):
    r = one(run(frame, tables, lab_row(1, "iu", 5.0)))
    assert (r.value_as_number, r.final_unit, r.unit_discord_flag) == (5.0, "iu", True)


def test_nan_is_missing_and_bounds_are_inside(frame, tables):
    rows = run(
        frame, tables, lab_row(1, "g", float("nan")), lab_row(2, "g", None), lab_row(3, "g", 1.0), lab_row(4, "g", 100.0),
        lab_row(5, "g", 100.5), lab_row(6, "g", 0.5),
    ).collect()
    flags = {r.person_id: (r.nan_flag, r.outlier_flag) for r in rows}
    assert flags == {1: (True, False), 2: (True, False), 3: (False, False), 4: (False, False), 5: (False, True), 6: (False, True)}


def test_stand_in_is_tested_after_conversion(frame, tables):
    rows = run(frame, tables, lab_row(1, "g", 10000000.0), lab_row(2, "kg", 10000000.0), lab_row(3, "kg", 10000.0))
    assert {r.person_id: r.nan_equiv_flag for r in rows.collect()} == {1: True, 2: False, 3: True}
    raw = run(frame, tables, lab_row(2, "kg", 10000000.0), check_raw=True)
    assert one(raw).nan_equiv_flag


def test_missing_standard_unit_matches_missing_factor_unit(frame, tables):
    tables["metadata"] = frame(META, (1, "lab", "n", None, 1.0, 100.0))
    tables["factors"] = frame(
        "lab_name string, assigned_unit string, standard_unit string, conversion_factor double", ("lab", "g", None, 2.0)
    )
    r = one(run(frame, tables, lab_row(1, "g", 5.0)))
    assert r.value_as_number == 10.0
    # both sides missing counts as a discordant unit
    assert r.unit_discord_flag


def test_trim_is_a_subset_and_metadata_name_is_not_used(frame, tables):
    df = run(frame, tables, lab_row(1, "g", 5.0), lab_row(2, "g", None), lab_row(3, "iu", 5.0))
    rows = labs.trim(df).collect()
    assert [(r.person_id, r.unit, r.standard_concept_name) for r in rows] == [(1, "g", "name in data")]


def test_project_contract_keeps_duplicates_and_checks_columns(frame):
    df = frame(LAB, lab_row(1, "g", 5.0), lab_row(1, "g", 5.0))
    assert labs.project_contract(df.withColumn("x", F.lit(1))).count() == 2
    with pytest.raises(ValueError):
        labs.project_contract(df.drop("src_id"))


def test_sites(frame):
    df = frame(
        "src_id string, value_as_number double",
        ("EHR site 250", 1.0), ("EHR site 25", 2.0), ("EHR site 250", None), (None, 3.0),
    )
    for sites in ([250], ["250"], ["EHR site 250"]):
        assert sorted(r.value_as_number for r in labs.drop_sites(df, sites).collect()) == [2.0, 3.0]
        assert one(labs.dropped_value_count(df, sites)).dropped_values == 1


def test_site_table_covers_both_concepts_of_a_pair(spark, frame):
    table = labs.site_drop_table(spark)
    rows = {(r.measurement_concept_id, r.src_id) for r in table.collect()}
    assert {(3045440, "EHR site 734"), (3023939, "EHR site 925"), (3013721, "EHR site 250")} <= rows
    df = frame("measurement_concept_id bigint, src_id string", (3023939, "EHR site 925"), (3023939, None), (1, "EHR site 925"))
    assert labs.drop_sites_by_concept(df, table).count() == 2


def test_update_outlier_bounds(frame):
    meta = frame(META, (2, "a", "n", "g", 1.0, 9.0), (1, "a", "n", "g", 1.0, 9.0), (3, "b", "n", "g", 1.0, 9.0))
    out = {r.measurement_concept_id: (r.minimum_value, r.maximum_value) for r in labs.update_outlier_bounds(meta, "a", None, 5).collect()}
    assert out == {1: (1.0, 5.0), 2: (1.0, 9.0), 3: (1.0, 9.0)}
    with pytest.raises(ValueError):
        labs.update_outlier_bounds(meta, "a")
    with pytest.raises(ValueError):
        labs.update_outlier_bounds(meta, "c", 1)


CLEAN = "person_id bigint, value_as_number double, measurement_datetime timestamp"


def test_person_summary(frame):
    day = lambda d, h=0: dt.datetime(2020, 1, d, h)
    df = frame(
        CLEAN,
        (1, 7.0, day(1)),
        (2, 1.0, day(1)), (2, 2.0, day(2)),
        (3, -1.0, day(1)), (3, -2.5, day(2)),
        (4, 5.0, day(3, 1)), (4, 9.0, day(3, 0)), (4, 1.0, day(2)),
    )
    rows = {r.person_id: tuple(r)[1:] for r in labs.person_summary(df).collect()}
    assert rows == {
        1: (7, 7, 7, 7, 1, 7),
        2: (1, 1, 2, 1, 2, 2),
        3: (-2, -1, -1, -1, 2, -2),
        4: (1, 5, 9, 5, 3, 9),
    }
    exact = {r.person_id: r.median for r in labs.person_summary(df, truncate=False).collect()}
    assert exact[2] == 1.5 and exact[3] == -1.75


def test_person_summary_of_large_groups_is_the_same(frame):
    rows = [(p, float((i * 37) % 101) / 4, dt.datetime(2020, 1, 1 + i % 28)) for p in (1, 2, 3) for i in range(60 * p)]
    df = frame(CLEAN, *rows)
    usual = sorted(map(tuple, labs.person_summary(df).collect()))
    for limits in ({"max_group_rows": 100}, {"max_group_rows": 100, "max_map_values": 20}):
        assert sorted(map(tuple, labs.person_summary(df, **limits).collect())) == usual


def test_hba1c_cleaning(frame):
    df = frame(
        "person_id bigint, unit_concept_name string, value_as_number double",
        (1, "milligram per deciliter", 100.0), (1, None, 6.0), (1, "unit", 7.0), (2, "percent", 51.0),
    )
    kept = labs.filter_value_cap(labs.convert_linear_unit(labs.exclude_units(df)))
    assert sorted(round(r.value_as_number, 6) for r in kept.collect()) == [round(146.7 / 28.7, 6), 6.0]
    assert [r.person_id for r in labs.person_median(kept).collect()] == [1]


def test_units_dist_without_clean_rows_and_single_rows(frame):
    df = frame(
        "assigned_unit string, person_id bigint, src_id string, value_as_number double, missing_value_flag boolean, "
        "outlier_flag boolean, conversion_factor double",
        ("g", 1, "a", 5.0, False, False, 1.0), ("iu", 1, "a", None, True, False, None), ("iu", 2, "a", 3.0, False, True, None),
    )
    for limits in ({}, {"max_group_rows": 1}, {"max_group_rows": 0, "max_map_values": 0}):
        rows = {r.assigned_unit: r for r in labs.units_dist(df, **limits).collect()}
        assert (rows["g"].median, rows["g"].std, rows["g"].filtered_count) == (5.0, None, 1)
        assert (rows["iu"].median, rows["iu"].missing, rows["iu"].outliers, rows["iu"].n_pids) == (None, 1, 1, 2)


def test_histogram_matches_numpy(frame):
    import numpy as np

    values = [0.0, 1.0, 2.0, 2.5, 9.0, 9.0, 4.49]
    df = frame("lab_name string, assigned_unit string, value_as_number double", *[("l", "u", v) for v in values])
    counts, edges = np.histogram(values, np.linspace(0, max(values), 10))
    mine = {r.bin: r.frequency for r in labs.histogram(df).collect()}
    assert [mine.get(i, 0) for i in range(9)] == counts.tolist()


def test_boxplot(frame):
    rows = [("s", "g", float(v), False) for v in (1, 2, 3, 4, 100)] + [("s", "g", None, True)]
    df = frame("src_id string, unit string, value_as_number double, missing_value_flag boolean", *rows)
    r = one(labs.boxplot_stats(df, "annotated", "unit"))
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n_outliers, r.n, r.use_log) == (2, 3, 4, 1, 4, 1, 5, False)
    with pytest.raises(ValueError):
        labs.boxplot_stats(df, "raw", "unit")
