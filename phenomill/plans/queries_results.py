"""Catalogue and association result queries with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenomill.functions import scalar
from phenomill.operators import catalogue, cohort, results
from phenomill.plans.registry import query, rounded
from phenomill.session import scratch_path, write_intermediate
from phenomill.sources import sinks
from phenomill.sources import results as result_files

# --- catalogue ---


@query("SELECT phecode, phenotype_ID, trait_type, invnormalise, tol, sex_specific_run FROM catalogue_codes")
def explode_phecodes(t):
    return catalogue.explode_phecodes(t.catalogue())


@query("""
    SELECT phenotype_ID, CASE WHEN phecode IS NOT NULL THEN coalesce(array_to_string(list_transform(
             list_filter(list_transform(string_split(phecode, ','), lambda x: trim(x)), lambda x: x <> '' AND x <> 'NaN'),
             lambda x: CASE WHEN regexp_full_match(x, '\\d+(\\.\\d+)?') THEN 'phe_' || x ELSE x END), ', '), '') END AS phecode
    FROM catalogue""")
def prefix_numeric_code(t):
    return catalogue.prefix_numeric_code(t.catalogue()).select("phenotype_ID", "phecode")


@query("SELECT phenotype_ID, phecode FROM catalogue WHERE phenotype_ID IN ('P1', 'P2', 'P30')")
def filter_phenotype_codes(t):
    return catalogue.filter_phenotype_codes(t.catalogue(), ["P1", "P2", "P30"]).select("phenotype_ID", "phecode")


@query("SELECT phecode FROM catalogue_codes")
def sorted_phenotypes(t):
    return catalogue.sorted_phenotypes(t.catalogue())


@query("""SELECT phenotype_ID, trim(split_part(phecode, ',', 1)) AS phecode_1, trim(split_part(phecode, ',', 2)) AS phecode_2
          FROM catalogue WHERE len(string_split(phecode, ',')) = 2""")
def filter_two_phecode(t):
    return catalogue.filter_two_phecode(t.catalogue())


@query("""SELECT phenotype_ID, coalesce(code_x, phecode) AS phecode
          FROM catalogue LEFT JOIN (SELECT p_name || ' ' || p_type AS k, max('X_' || p_brand) AS code_x FROM part GROUP BY 1) x
            ON phenotype || ' STANDARD' = k""")
def lookup_join(t):
    part = t.raw("part").select(
        F.concat_ws(" ", "p_name", "p_type").alias("key"), F.concat(F.lit("X_"), "p_brand").alias("code_x")
    )
    keyed = t.catalogue().withColumn("key", F.concat("phenotype", F.lit(" STANDARD")))
    return catalogue.lookup_join(keyed, part, "key", "code_x", "phecode", F.col("phecode")).select("phenotype_ID", "phecode")


@query("""SELECT phenotype_ID, 'A_' || phenotype_ID AS phecode FROM catalogue""")
def attach_codes(t):
    """Every phenotype has two crosswalk rows; the later one counts."""
    number = F.col("p_partkey")
    crosswalk = t.raw("part").select(
        F.concat(F.lit("P"), number.cast("string")).alias("source_code"),
        F.explode(F.array(F.lit("Z"), F.lit("A"))).alias("first"),
    )
    crosswalk = crosswalk.select(
        "source_code",
        F.concat_ws("_", "first", "source_code").alias("target_code"),
        F.when(F.col("first") == "A", 2).otherwise(1).alias("ord"),
    )
    return catalogue.attach_codes(t.catalogue(), crosswalk).select("phenotype_ID", "phecode")


@query("""SELECT DISTINCT p_partkey AS concept_id, lower(p_name) AS concept_name, lower(p_name) AS short_name,
                 'pfhh_' || p_partkey || '_summary.ipynb' AS notebook_name,
                 'https://example.org/preview/pfhh_' || p_partkey || '_summary.ipynb' AS notebook_url FROM part""")
def phenotype_index(t):
    return catalogue.phenotype_index(t.concept(), "pfhh", "concept_id", "https://example.org/preview")


@query("""SELECT phenotype_ID, CASE WHEN lower(trim(sex_specific_run)) IN ('male', 'female') THEN lower(trim(sex_specific_run)) ELSE 'FALSE' END AS sex,
                 CASE WHEN sex_specific_run IN ('Male', 'Female') THEN '_' || lower(sex_specific_run) ELSE '' END AS tag
          FROM catalogue""")
def sex_flag_and_tag(t):
    run = F.col("sex_specific_run")
    return t.catalogue().select(
        "phenotype_ID", scalar.sex_flag(run).alias("sex"), scalar.cohort_tag(run).alias("tag")
    )


GRID = {"ancestry": ["afr", "amr", "eas", "eur", "sas"], "prune": ["snp"], "variant": ["plof", "missense"]}


@query("""SELECT phecode, ancestry, 'snp' AS prune_method, variant_class
          FROM catalogue_codes, (VALUES ('afr'), ('amr'), ('eas'), ('eur'), ('sas')) a(ancestry),
               (VALUES ('plof'), ('missense')) v(variant_class)
          WHERE NOT (ancestry = 'eur' AND starts_with(phecode, 'GR_'))""")
def run_grid(t):
    codes = catalogue.sorted_phenotypes(t.catalogue())
    finished = codes.where(F.col("phecode").startswith("GR_")).withColumn("ancestry", F.lit("eur"))
    return cohort.run_grid(codes, GRID["ancestry"], GRID["prune"], GRID["variant"], finished)


# --- association results ---


@query("""SELECT MarkerID, Ancestry, replace(Trait, ' ', '') AS Trait, VariantClass FROM association_results""")
def parse_file_name(t):
    """File names as the scans wrote them, taken apart again."""
    name = F.concat(
        F.lit("/out/aou_snp_"), "Ancestry", F.lit("_step2_"), "Trait", F.lit("_vars_"), "VariantClass", F.lit(".txt")
    )
    files = t.association_results().select("MarkerID", name.alias("file"))
    return result_files.parse_file_name(files, "file").drop("file")


FILES = {
    "has_n_case": ["CHR", "POS", "MarkerID", "AC_Allele2", "AF_Allele2", "p.value", "N_case"],
    "NOT has_n_case AND Ancestry <> 'anc0'": ["MarkerID", "p.value", "Note", "AF_Allele2", "AC_Allele2"],
    "NOT has_n_case AND Ancestry = 'anc0'": ["POS", "AC_Allele2", "AF_Allele2", "p.value"],
}


@query("""SELECT CASE WHEN has_n_case OR Ancestry <> 'anc0' THEN MarkerID END AS MarkerID, AC_Allele2, AF_Allele2, round("p.value", 12) AS "p.value", N_case,
                 CASE WHEN has_n_case THEN 'chr1' END AS CHR, CASE WHEN has_n_case OR Ancestry = 'anc0' THEN CAST(length(MarkerID) AS VARCHAR) END AS POS,
                 CASE WHEN NOT has_n_case AND Ancestry <> 'anc0' THEN VariantClass END AS Note,
                 has_n_case, has_n_case OR Ancestry <> 'anc0' AS has_marker, TRUE AS has_af
          FROM association_results""")
def scan_result_files(t):
    """Files with three headers: one that begins with other columns, one without case counts, one without markers."""
    path = scratch_path(t.spark, "results")
    more = {"CHR": F.lit("chr1"), "POS": F.length("MarkerID"), "Note": F.col("VariantClass")}
    rows = write_intermediate(t.association_results().withColumns(more), "results")
    for number, (condition, columns) in enumerate(FILES.items()):
        sinks.write_tsv(rows.where(condition).select(*[f"`{c}`" for c in columns]), f"{path}/{number}")
    out = result_files.scan_result_files(t.spark, path, pattern=r"(part)-(\d+)-(.+)", glob="part-*")
    columns = ["MarkerID", "AC_Allele2", "AF_Allele2", "p.value", "N_case", "CHR", "POS", "Note", "has_n_case", "has_marker", "has_af"]
    return rounded(out.select(*[f"`{c}`" for c in columns]), "p.value", places=12)


RESULT = 'MarkerID, Ancestry, Trait, VariantClass, AC_Allele2, AF_Allele2, round("p.value", 12) AS "p.value", N_case'


def _result(df):
    return rounded(
        df.select("MarkerID", "Ancestry", "Trait", "VariantClass", "AC_Allele2", "AF_Allele2", "`p.value`", "N_case"),
        "p.value",
        places=12,
    )


def filtered(t):
    return results.filter_results(t.association_results())


@query(f"SELECT {RESULT} FROM filtered_results")
def filter_results(t):
    return _result(filtered(t))


@query(f"SELECT {RESULT} FROM association_results WHERE has_n_case UNION ALL SELECT {RESULT} FROM association_results WHERE NOT has_n_case")
def concat_results(t):
    rows = t.association_results()
    return _result(
        results.concat_results([rows.where("has_n_case"), rows.where("NOT has_n_case").drop("N_case")])
    )


@query(f"SELECT {RESULT} FROM filtered_results")
def sort_results(t):
    return _result(results.sort_results(filtered(t)))


@query(f'SELECT {RESULT} FROM filtered_results WHERE "p.value" < 1e-7')
def hits(t):
    return _result(results.hits(filtered(t)))


@query(f"""SELECT {RESULT} FROM (SELECT *, row_number() OVER (PARTITION BY Trait ORDER BY "p.value", MarkerID, Ancestry, VariantClass) AS rn
           FROM filtered_results) WHERE rn <= 10""")
def top_hits(t):
    return _result(results.top_hits(filtered(t), 10))


@query("SELECT MarkerID, Ancestry, Trait, VariantClass, AF_Allele2 FROM association_results WHERE AF_Allele2 >= 0.5")
def filter_high_af(t):
    return results.filter_high_af(t.association_results()).select("MarkerID", "Ancestry", "Trait", "VariantClass", "AF_Allele2")


@query("SELECT DISTINCT MarkerID AS Gene, Ancestry, VariantClass FROM association_results WHERE AF_Allele2 >= 0.5")
def distinct_combos(t):
    return results.distinct_combos(results.filter_high_af(t.association_results()))


@query("""SELECT MarkerID, Ancestry, Trait, VariantClass,
                 CASE WHEN AC_Allele2 < 40 THEN '<40' ELSE CAST(CAST(AC_Allele2 AS BIGINT) AS VARCHAR) END AS AC_Allele2
          FROM association_results""")
def censor_small_counts(t):
    return t.association_results().select(
        "MarkerID", "Ancestry", "Trait", "VariantClass", results.censor_small_counts(F.col("AC_Allele2")).alias("AC_Allele2")
    )


@query("""
    SELECT MarkerID, r.Ancestry, CASE WHEN AC_Allele2 < 40 THEN '<40' ELSE CAST(CAST(AC_Allele2 AS BIGINT) AS VARCHAR) END AS AC_Allele2,
           coalesce(c.phenotype_ID, r.Trait) AS Trait, r.Trait AS phecode, VariantClass, N_case,
           CASE WHEN lower(trim(c.sex_specific_run)) IN ('male', 'female') THEN lower(trim(c.sex_specific_run)) ELSE 'FALSE' END AS Sex_Specific
    FROM filtered_results r LEFT JOIN catalogue_codes c ON r.Trait = c.phecode""")
def censor_results(t):
    empty = {c: F.lit(None).cast("double") for c in ("BETA", "SE", "Tstat", "var", "N", "N_ctrl")}
    rows = filtered(t).withColumns({**empty, "Is.SPA": F.lit(None).cast("boolean")})
    return results.censor_results(rows, t.catalogue()).select(
        "MarkerID", "Ancestry", "AC_Allele2", "Trait", "phecode", "VariantClass", "N_case", "Sex_Specific"
    )


@query("""
    SELECT Ancestry, Trait, VariantClass, rank, round(-log10(rank / (n + 1)), 6) AS expected, round(-log10(p), 6) AS observed
    FROM (SELECT Ancestry, Trait, VariantClass, "p.value" AS p,
                 row_number() OVER (PARTITION BY Ancestry, Trait, VariantClass ORDER BY "p.value") AS rank,
                 count(*) OVER (PARTITION BY Ancestry, Trait, VariantClass) AS n
          FROM association_results WHERE AF_Allele2 < 0.5 AND "p.value" IS NOT NULL)""")
def qq_points(t):
    return rounded(results.qq_points(t.association_results()), "expected", "observed")


@query("""SELECT Ancestry, Trait, VariantClass, round(median(N_case), 6) AS median_n_case FROM association_results
          WHERE AF_Allele2 < 0.5 AND N_case IS NOT NULL GROUP BY ALL""")
def median_n_case(t):
    return rounded(results.median_n_case(t.association_results()), "median_n_case")
