"""Sources and sinks: tables written and read back, with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenomill.plans.registry import query, rounded
from phenomill.session import scratch_path
from phenomill.sources import readers, sinks


@query("""SELECT p_partkey AS measurement_concept_id, p_name AS lab_name, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS maximum_value, 'metadata' AS tab FROM part
          UNION ALL SELECT p_partkey, p_brand, NULL, 'unit_map' FROM part UNION ALL SELECT p_partkey, p_type, NULL, 'unit_reduce' FROM part
          UNION ALL SELECT s_suppkey, s_name, NULL, 'site_drop' FROM supplier""")
def scan_dictionaries(t):
    """Four lookup tables under a version; NaN comes back as NULL."""
    path = scratch_path(t.spark, "dictionaries")
    part = t.raw("part")
    value = F.when(F.col("p_size") % 5 == 0, float("nan")).otherwise(F.col("p_retailprice"))
    none = F.lit(None).cast("double")
    tables = {
        "metadata": part.select("p_partkey", "p_name", value),
        "unit_map": part.select("p_partkey", "p_brand", none),
        "unit_reduce": part.select("p_partkey", "p_type", none),
        "site_drop": t.spark.read.parquet(f"{t.folder}/supplier.parquet").select("s_suppkey", "s_name", none),
    }
    for name, table in tables.items():
        table.toDF("measurement_concept_id", "lab_name", "maximum_value").write.parquet(f"{path}/v9/{name}_v9")
    read = readers.scan_dictionaries(t.spark, path, "v9")
    parts = [read[name].withColumn("tab", F.lit(name)) for name in readers.DICTIONARIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""SELECT phenotype_ID, phenotype, sex_specific_run, trait_type, invnormalise, tol, nullif(phecode, 'NaN') AS phecode FROM catalogue""")
def scan_phenotype_catalogue(t):
    """The catalogue as JSON lines; bare NaN codes are NULL."""
    path = scratch_path(t.spark, "catalogue")
    sinks.write_catalogue_json(t.catalogue().drop("ord"), path)
    return readers.scan_phenotype_catalogue(t.spark, path, lines=True).drop("ord", "definition")


@query("""SELECT MarkerID, Ancestry, Trait, VariantClass, CAST(AC_Allele2 AS VARCHAR) AS AC_Allele2,
                 CASE WHEN has_n_case THEN CAST(N_case AS VARCHAR) END AS N_case FROM association_results""")
def write_gzip_tsv(t):
    """Results as compressed text and back; missing counts stay missing."""
    path = scratch_path(t.spark, "release")
    sinks.write_gzip_tsv(t.association_results().select("MarkerID", "Ancestry", "Trait", "VariantClass", "AC_Allele2", "N_case"), path)
    return readers.scan_delimited(t.spark, path, sep="\t")


@query("""SELECT row_number() OVER (ORDER BY v DESC) AS PC, round(v, 6) AS Eigenvalue
          FROM (SELECT DISTINCT CAST(avg(o_totalprice) AS DOUBLE) AS v FROM orders GROUP BY o_orderpriority)""")
def write_eigenvalues(t):
    """A descending array as a numbered file and back."""
    path = scratch_path(t.spark, "eigenvalues")
    means = t.raw("orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("v"))
    values = means.agg(F.reverse(F.array_sort(F.collect_list("v"))).alias("values"))
    sinks.write_eigenvalues(sinks.eigenvalue_rows(values, "values"), path)
    return rounded(readers.scan_delimited(t.spark, path, "PC bigint, Eigenvalue double", sep="\t"), "Eigenvalue")


@query("SELECT CAST(person_id AS VARCHAR) AS s FROM person")
def write_sample_ids(t):
    path = scratch_path(t.spark, "ids")
    sinks.write_sample_ids(t.person(), path)
    return readers.scan_sample_list(t.spark, path, header=False)
