from __future__ import annotations

import gzip
import json
import math

import pytest
from pyspark.sql import functions as F

from phenomill.operators import results, structure
from phenomill.sources import readers, sinks
from phenomill.sources import results as result_files


def put(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def folder(tmp_path):
    put(
        tmp_path, "aou_snp_eur_step2_phe_1_vars_plof.txt",
        "MarkerID\tAC_Allele2\tAF_Allele2\tp.value\tN_case\tN_ctrl",
        "g1\t40\t0.1\t1e-300\t100\t900", "g2\t10\t0.1\tNA\t100\t900", "g3\t9\t0.1\t0.5\t100\t900", "g4\t50\t0.5\t1e-9\t100\t900",
        "g5\t50\t0.2\t1e-9\t\t900", "g6\t50\t0.2\t1e-9\t99\t900",
    )
    put(
        tmp_path, "aou_snp_afr_step2_height_vars_missense.txt",
        "MarkerID\tp.value\tAC_Allele2\tAF_Allele2\tN", "g1\t1e-7\t39\t0.49\t5000", "g7\t0.04\t1000\t0.6\t5000",
    )
    put(tmp_path, "aou_snp_afr_step2_height_vars_ADDITIVE.txt", "MarkerID\tAC_Allele2\tAF_Allele2\tp.value", "g9\t100\t0.7\t0.1")
    put(tmp_path, "other.txt", "MarkerID\tAC_Allele2\tAF_Allele2\tp.value", "g8\t100\t0.7\t0.1")
    return str(tmp_path)


def test_files_with_different_headers(spark, folder):
    df = result_files.scan_result_files(spark, folder)
    rows = {(r.MarkerID, r.Ancestry): r for r in df.collect()}
    assert len(rows) == 8 and ("g9", "afr") not in rows
    first = rows[("g1", "eur")]
    assert (first.Trait, first.VariantClass, first.N_case, first["p.value"], first.has_n_case) == ("phe_1", "plof", 100.0, 1e-300, True)
    second = rows[("g1", "afr")]
    assert (second.Trait, second.N_case, second["p.value"], second.N, second.has_n_case) == ("height", None, 1e-7, 5000.0, False)

    kept = results.filter_results(df)
    assert {r.MarkerID for r in kept.where("Ancestry = 'eur'").collect()} == {"g1", "g2"}
    assert {r.MarkerID for r in kept.where("Ancestry = 'afr'").collect()} == {"g1"}
    assert [r.MarkerID for r in results.sort_results(kept).collect()] == ["g1", "g1", "g2"]
    assert [r["p.value"] for r in results.hits(kept).collect()] == [1e-300]
    everything = result_files.scan_result_files(spark, folder, with_additive=True)
    combos = results.distinct_combos(results.filter_high_af(everything))
    assert {tuple(r) for r in combos.collect()} == {("g4", "eur", "plof"), ("g7", "afr", "missense"), ("g9", "afr", "ADDITIVE")}


def test_any_header_is_read_whole(spark, tmp_path):
    put(tmp_path, "aou_snp_eur_step2_a_vars_plof.txt", "CHR\tPOS\tMarkerID\tp.value\tAF_Allele2", "1\t5\tm1\t0.5\t0.7", "1\t6\tMarkerID\t0.25\t0.1")
    put(tmp_path, "aou_snp_eur_step2_b_vars_plof.txt", "p.value\tAF_Allele2\tCHR", "0.125\t0.9\t2", "0.5\t0.9")
    (tmp_path / "aou_snp_eur_step2_c_vars_plof.txt").write_text("")
    df = result_files.scan_result_files(spark, str(tmp_path))
    rows = {(r.Trait, r["p.value"]): r for r in df.collect()}
    assert len(rows) == 4 and rows[("a", 0.5)].POS == "5" and rows[("a", 0.25)].MarkerID == "MarkerID"
    assert rows[("b", 0.125)].CHR == "2" and rows[("b", 0.125)].MarkerID is None and rows[("b", 0.5)].CHR is None
    assert [r.has_marker for r in df.select("Trait", "has_marker").distinct().orderBy("Trait").collect()] == [True, False]
    assert {r.Trait for r in results.filter_high_af(df).collect()} == {"a"}
    put(tmp_path, "mine-x-y-z.tsv", "MarkerID\tp.value", "q\t1")
    own = result_files.scan_result_files(spark, str(tmp_path), pattern=r"mine-(\w)-(\w)-(\w)", glob="mine-*.tsv")
    assert [(r.Ancestry, r.Trait, r.VariantClass, r["p.value"]) for r in own.collect()] == [("x", "y", "z", 1.0)]
    assert result_files.scan_result_files(spark, str(tmp_path), glob="none*").count() == 0


def test_censoring(frame):
    df = frame("ac double", (9.0,), (39.0,), (40.0,), (None,))
    assert [r[0] for r in df.select(results.censor_small_counts(F.col("ac"))).collect()] == ["<40", "<40", "40", None]


def test_release_form(spark, frame, folder, tmp_path):
    catalogue = frame(
        "phenotype_ID string, trait_type string, invnormalise string, tol double, sex_specific_run string, phecode string, ord int",
        ("Asthma", "binary", "FALSE", 0.02, " Female", "phe_1, x", 1),
    )
    df = result_files.scan_result_files(spark, folder)
    out = results.censor_results(df, catalogue)
    assert out.columns == results.RELEASE_COLUMNS
    rows = {(r.MarkerID, r.Ancestry): r for r in out.collect()}
    assert (rows[("g1", "eur")].Trait, rows[("g1", "eur")].phecode, rows[("g1", "eur")].Sex_Specific) == ("Asthma", "phe_1", "female")
    assert (rows[("g1", "afr")].Trait, rows[("g1", "afr")].AC_Allele2, rows[("g1", "afr")].Sex_Specific) == ("height", "<40", "FALSE")
    missing = results.censor_results(df.withColumn("Trait", F.lit(None).cast("string")), catalogue)
    assert {r.Trait for r in missing.collect()} == {"UNKNOWN"}
    path = tmp_path / "release"
    sinks.write_gzip_tsv(out, str(path))
    lines = [line for p in path.glob("part-*.gz") for line in gzip.open(p, "rt").read().splitlines()]
    assert lines[0].split("\t") == results.RELEASE_COLUMNS


def test_qq_points(frame):
    schema = "Ancestry string, Trait string, VariantClass string, AF_Allele2 double, `p.value` double"
    ps = [0.5, 0.01, 0.5, 0.5, None, 1e-300]
    df = frame(schema, *[("e", "t", "c", 0.1, p) for p in ps], ("e", "t", "c", 0.5, 1e-9), ("e", "one", "c", 0.1, 0.25))
    rows = results.qq_points(df).orderBy("Trait", "rank").collect()
    many = [r for r in rows if r.Trait == "t"]
    assert [r.rank for r in many] == [1, 2, 3, 4, 5]
    assert [r.observed for r in many] == pytest.approx([300.0, 2.0, -math.log10(0.5), -math.log10(0.5), -math.log10(0.5)])
    assert [r.expected for r in many] == pytest.approx([-math.log10(i / 6) for i in range(1, 6)])
    single = [r for r in rows if r.Trait == "one"]
    assert [(r.rank, r.expected) for r in single] == [(1, pytest.approx(-math.log10(0.5)))]


def test_catalogue_file(spark, tmp_path):
    path = tmp_path / "catalogue.json"
    path.write_text(
        '[{"phenotype": "a", "sex_specific_run": "", "phenotype_ID": "A", "trait_type": "binary", "tol": 0.02, "phecode": "phe_495, RE_475"},'
        '{"phenotype_ID": "B", "phecode": NaN}, {"phenotype_ID": "C", "phecode": 4134857}, {"phenotype_ID": "D"}]'
    )
    df = readers.scan_phenotype_catalogue(spark, str(path))
    assert [(r.phenotype_ID, r.phecode) for r in df.orderBy("ord").collect()] == [
        ("A", "phe_495, RE_475"), ("B", None), ("C", "4134857"), ("D", None),
    ]
    sinks.write_catalogue_json(df.drop("ord"), str(tmp_path / "out"))
    entries = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    assert {e["phenotype_ID"] for e in entries} == {"A", "B", "C", "D"}


def test_delimited_files(spark, tmp_path):
    put(tmp_path, "plain.csv", "1,40,x", "2,50,y")
    df = readers.scan_delimited(spark, str(tmp_path / "plain.csv"), "person_id string, age int, c string", header=False)
    assert [tuple(r) for r in df.collect()] == [("1", 40, "x"), ("2", 50, "y")]
    put(tmp_path, "blank.txt", "MarkerID  p.value", "a   0.5", "b\t1e-3")
    blank = readers.scan_whitespace(spark, str(tmp_path / "blank.txt"), ["MarkerID", "p.value"])
    assert [tuple(r) for r in blank.collect()] == [("a", "0.5"), ("b", "1e-3")]
    put(tmp_path, "head.csv", "person_id,495", "1,TRUE")
    assert readers.header_columns(spark, str(tmp_path / "head.csv")) == ["person_id", "495"]
    put(tmp_path, "quoted.tsv", 's\tscores', '"1"\t"[0.1,0.2]"')
    assert readers.scan_delimited(spark, str(tmp_path / "quoted.tsv"), sep="\t").first().scores == "[0.1,0.2]"


def test_measurement_summaries(spark, tmp_path):
    put(tmp_path, "measurement_3006923_summary.csv", "person_id,min,median", "1,2,3", "2,4,5")
    put(tmp_path, "measurement_3045440_3023939_summary.csv", "person_id,min,median", "1,7,8")
    put(tmp_path, "other.csv", "person_id,min,median", "1,9,9")
    put(tmp_path, "measurement_77_summary.csv", "person_id,median", "4,6.5")
    put(tmp_path, "measurement_78_summary.csv", "note,median,person_id,mean", '"x,y",7,5,1')
    df = readers.scan_measurement_summaries(spark, str(tmp_path))
    rows = sorted(map(tuple, df.collect()))
    assert rows == [(1, "3006923", 3.0), (1, "3045440_3023939", 8.0), (2, "3006923", 5.0), (4, "77", 6.5), (5, "78", 7.0)]
    put(tmp_path, "measurement_79_summary.csv", "median", "1")
    with pytest.raises(ValueError):
        readers.scan_measurement_summaries(spark, str(tmp_path))


def test_dictionaries(spark, frame, tmp_path):
    for name in readers.DICTIONARIES:
        frame("a string, v double", (name, float("nan"))).write.parquet(str(tmp_path / "v2" / f"{name}_v2"))
    tables = readers.scan_dictionaries(spark, str(tmp_path), "v2")
    assert {k: v.first().a for k, v in tables.items()} == {n: n for n in readers.DICTIONARIES}
    assert tables["metadata"].first().v is None


def test_sinks(spark, frame, tmp_path):
    df = frame("person_id bigint, name string, scores array<double>", (1, 'a "b", c', [1.0, 2.5]), (2, None, None))
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "csv"))
    assert back.where("person_id = 1").first().name == 'a "b", c'
    sinks.write_csv(df.select("person_id"), str(tmp_path / "plain"), quoted=False)
    sinks.write_tsv(df, str(tmp_path / "tsv"))
    lines = [x for p in (tmp_path / "tsv").glob("part-*") for x in p.read_text().splitlines()]
    assert any("[1.0,2.5]" in x for x in lines)
    sinks.write_sample_ids(df, str(tmp_path / "ids"))
    ids = [x for p in (tmp_path / "ids").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(ids) == ["1", "2"]
    sinks.write_eigenvalues(structure.eigenvalue_table(spark, [3.0, 1.5]), str(tmp_path / "eigen"))
    eigen = [x for p in sorted((tmp_path / "eigen").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x for x in eigen if x[0] != "P"] == ["1\t3.0", "2\t1.5"]
    rows = sinks.eigenvalue_rows(frame("e array<double>", ([3.0, 1.5],)), "e").collect()
    assert [tuple(r) for r in rows] == [(1, 3.0), (2, 1.5)]
    sinks.write_person_summary(frame("person_id bigint, median bigint", (1, 2)), str(tmp_path / "ps"), "1_2")
    assert (tmp_path / "ps" / "concept_key=1_2").is_dir()
