"""The driver's tables read as the clinical and genotype tables the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenomill.session import small_table
from phenomill.operators import variant_rows
from phenomill.session import write_intermediate


# Schemas of the tables used, so that opening a table reads no footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


class Tables:
    """Views of one test data folder. ``raw`` gives a table as it is."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def lo(self) -> DataFrame:
        """Line items with the person of their order."""
        orders = self.raw("orders").select("o_orderkey", F.col("o_custkey").alias("person_id"))
        items = self.raw("lineitem")
        return items.join(orders, items["l_orderkey"] == orders["o_orderkey"])

    # --- persons ---

    def person(self) -> DataFrame:
        rest = F.col("c_custkey") % 5
        concept = F.when(rest == 0, 0).when(rest.isin(1, 3), 45878463).otherwise(45880669)
        return self.raw("customer").select(
            F.col("c_custkey").alias("person_id"), concept.cast("bigint").alias("sex_at_birth_concept_id")
        )

    def cb_search_person(self) -> DataFrame:
        key = F.col("c_custkey")
        rest = key % 5
        return self.raw("customer").select(
            key.alias("person_id"),
            F.when(key % 41 != 0, 18 + (key * 7) % 90).alias("age_at_cdr"),
            F.when(rest == 0, "Unknown").when(rest.isin(1, 3), "Female").otherwise("Male").alias("sex_at_birth"),
            F.when(key % 10 < 8, 1).otherwise(0).alias("has_ehr_data"),
            F.col("c_mktsegment").alias("ancestry"),
        )

    def population(self) -> DataFrame:
        return self.cb_search_person().where("has_ehr_data = 1").select("person_id").distinct()

    # --- labs ---

    def measurement(self) -> DataFrame:
        """The joined ten-column extract."""
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        lab = 1 + F.col("l_linenumber") % 2
        return self.lo().select(
            "person_id",
            lab.cast("bigint").alias("measurement_concept_id"),
            F.concat(F.lit("EHR site "), F.col("l_suppkey").cast("string")).alias("src_id"),
            F.col("l_shipdate").alias("measurement_datetime"),
            F.concat(F.lit("lab "), lab.cast("string")).alias("standard_concept_name"),
            F.concat(F.lit("code "), lab.cast("string")).alias("standard_concept_code"),
            F.lit("LOINC").alias("standard_vocabulary"),
            F.when((flag != "R") | (status != "F"), flag).alias("unit_concept_name"),
            F.when(F.col("l_quantity") == 50, 10000000.0).otherwise(F.col("l_quantity")).alias("value_as_number"),
            F.lit(None).cast("string").alias("operator_concept_name"),
        )

    def metadata(self) -> DataFrame:
        return small_table(
            self.spark,
            "measurement_concept_id bigint, lab_name string, standard_concept_name string, "
            "standard_unit string, minimum_value double, maximum_value double",
            [(1, "lab1", "lab 1", "A", 1.0, 45.0), (2, "lab2", "lab 2", "A", 1.0, 45.0)],
        )

    def unit_map(self) -> DataFrame:
        """A raw unit that does not occur, so that nothing is renamed."""
        return small_table(
            self.spark, "assigned_unit string, reduced_unit string, ord int", [("absent", "A", 1)]
        )

    def renaming_unit_map(self) -> DataFrame:
        """R is renamed twice (the last entry counts); N maps to nothing."""
        return small_table(
            self.spark,
            "assigned_unit string, reduced_unit string, ord int",
            [("R", "X", 1), ("R", "A", 2), ("N", None, 3)],
        )

    def unit_factors(self) -> DataFrame:
        rows = [(lab, u, "A", f) for lab in ("lab1", "lab2") for u, f in (("A", 1.0), ("N", 0.1), ("R", 0.0))]
        return small_table(
            self.spark, "lab_name string, assigned_unit string, standard_unit string, conversion_factor double", rows
        )

    def site_drops(self) -> DataFrame:
        return small_table(
            self.spark, "measurement_concept_id bigint, src_id string", [(1, "EHR site 25"), (1, "EHR site 50")]
        )

    def omop_measurement(self) -> DataFrame:
        """The fact table before its joins."""
        flag = F.col("l_returnflag")
        unit = F.when((flag == "R") & (F.col("l_linestatus") == "F"), None).when(flag == "A", 3).when(flag == "N", 4).otherwise(5)
        return self.lo().select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("measurement_id"),
            "person_id",
            (1 + F.col("l_linenumber") % 2).cast("bigint").alias("measurement_concept_id"),
            F.col("l_shipdate").alias("measurement_datetime"),
            F.col("l_quantity").alias("value_as_number"),
            F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey")).alias("value_as_concept_id"),
            unit.cast("bigint").alias("unit_concept_id"),
            F.when(F.col("l_suppkey") % 2 == 0, 6).cast("bigint").alias("operator_concept_id"),
            F.col("l_partkey").alias("measurement_source_concept_id"),
            F.concat(F.lit("SRC "), flag).alias("measurement_source_value"),
            F.col("l_linestatus").alias("unit_source_value"),
        )

    def measurement_ext(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("measurement_id"),
            F.concat(F.lit("EHR site "), (F.col("l_orderkey") % 100).cast("string")).alias("src_id"),
        ).distinct()

    # --- diagnoses ---

    def concept(self) -> DataFrame:
        kind = F.col("p_type")
        return self.raw("part").select(
            F.col("p_partkey").alias("concept_id"),
            F.col("p_name").alias("concept_name"),
            F.col("p_brand").alias("concept_code"),
            F.when(kind == "STANDARD", "ICD9CM").when(kind == "PROMO", "ICD10CM").otherwise("SNOMED").alias("vocabulary_id"),
        )

    def icd_branches(self) -> list[DataFrame]:
        rows = self.lo().select(
            "person_id",
            F.col("l_partkey").alias("source_concept_id"),
            F.to_date("l_shipdate").alias("date"),
            (F.col("l_linenumber") % 4).alias("branch"),
        )
        return [rows.where(F.col("branch") == i).drop("branch") for i in range(4)]

    def code_map(self) -> DataFrame:
        number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint")
        return (
            self.raw("part")
            .select("p_brand")
            .distinct()
            .select(
                F.col("p_brand").alias("code"),
                F.explode(F.array(F.lit("ICD9CM"), F.lit("ICD10CM"))).alias("vocabulary_id"),
                F.concat(F.lit("GR_"), (number % 5).cast("string"), F.lit("."), number.cast("string")).alias("phecode"),
            )
        )

    def rollup(self) -> DataFrame:
        own = self.code_map().select("phecode").distinct()
        parent = F.split("phecode", r"\.")[0]
        return own.select(
            F.col("phecode").alias("code"), F.explode(F.array("phecode", parent)).alias("phecode_unrolled")
        )

    def restrictions(self) -> DataFrame:
        return small_table(
            self.spark,
            "phecode string, male_only boolean, female_only boolean",
            [("GR_0", False, True), ("GR_1", True, False)],
        )

    # --- surveys, physical measurements, procedures ---

    def ds_survey(self) -> DataFrame:
        part = F.col("event_id") % 3
        position = F.array_position(
            F.array(*[F.lit(v) for v in ("click", "error", "purchase", "signup", "view")]), F.col("event_type")
        )
        return self.raw("events").select(
            F.col("user_id").alias("person_id"),
            F.when(F.col("event_id") % 10 < 9, "The Basics").otherwise("Lifestyle").alias("survey"),
            F.concat(F.lit("Topic"), part.cast("string"), F.lit(": "), F.col("event_type")).alias("question"),
            (100 * part + position).cast("bigint").alias("question_concept_id"),
            F.concat(F.lit("PMI: "), (F.col("event_id") % 7).cast("string")).alias("answer"),
        )

    def physical_measurement(self) -> DataFrame:
        line = F.col("l_linenumber")
        name = (
            F.when(line == 1, "Height")
            .when(line == 2, "weight")
            .when(line == 3, "waist-circumference-mean")
            .when(line == 4, "hip-circumference-mean")
            .otherwise("other")
        )
        return self.lo().select(
            "person_id", name.alias("measurement_source_value"), (100 + F.col("l_quantity")).alias("value_as_number")
        )

    def procedure_occurrence(self) -> DataFrame:
        return self.lo().select(
            "person_id",
            F.when(F.col("l_partkey") % 97 == 0, 4134857).otherwise(F.col("l_partkey")).alias("procedure_concept_id"),
        )

    # --- results and catalogue ---

    def association_results(self) -> DataFrame:
        # One row per part and region: the regions, a handful, are one value that each part explodes.
        keys = self.raw("region").agg(F.collect_list(F.col("r_regionkey").cast("bigint"))).scalar()
        part = self.raw("part").withColumn("nk", F.explode(keys))
        key, nk = F.col("p_partkey"), F.col("nk")
        binary = F.col("p_type").isin("STANDARD", "PROMO", "SMALL")
        score = key * 13 + nk
        return part.select(
            F.concat(F.col("p_name"), F.lit(" "), key.cast("string")).alias("MarkerID"),
            F.concat(F.lit("anc"), nk.cast("string")).alias("Ancestry"),
            F.col("p_type").alias("Trait"),
            F.col("p_brand").alias("VariantClass"),
            F.col("p_size").cast("double").alias("AC_Allele2"),
            ((key % 100) / 100.0).alias("AF_Allele2"),
            (F.pow(F.lit(10.0), -(score % 12).cast("double")) / (1 + key % 9)).alias("p.value"),
            F.when(binary, (50 + key % 400).cast("double")).alias("N_case"),
            binary.alias("has_n_case"),
            F.lit(True).alias("has_af"),
            F.lit(True).alias("has_marker"),
        )

    def catalogue(self) -> DataFrame:
        """A phenotype entry per part; code lists of every shape."""
        key = F.col("p_partkey")
        code = F.concat(F.lit("GR_"), (key % 5).cast("string"))
        fine = F.concat(code, F.lit("."), (key % 25).cast("string"))
        shape = key % 6
        codes = (
            F.when(shape == 0, F.concat(code, F.lit(", "), fine))
            .when(shape == 1, F.concat((key % 300).cast("string"), F.lit("."), (key % 3).cast("string")))
            .when(shape == 2, (4134857 + key % 50).cast("string"))
            .when(shape == 3, "NaN")
            .when(shape == 4, F.concat_ws(", ", code, fine, (key % 40).cast("string"), F.lit("RE_475"), F.col("p_type")))
        )
        return self.raw("part").select(
            F.concat(F.lit("P"), key.cast("string")).alias("phenotype_ID"),
            F.col("p_name").alias("phenotype"),
            F.when(key % 3 == 0, "").when(key % 3 == 1, "Female").otherwise(" Male ").alias("sex_specific_run"),
            F.when(key % 4 == 0, "quantitative").otherwise("binary").alias("trait_type"),
            F.when(key % 4 == 0, "TRUE").otherwise("FALSE").alias("invnormalise"),
            F.when(key % 2 == 0, 0.02).otherwise(0.2).alias("tol"),
            codes.alias("phecode"),
            key.alias("ord"),
        )

    # --- genotypes ---

    def sample_dosages(self) -> DataFrame:
        """(s, label, dosages): 64 markers per sample."""

        def element(x, j):
            # element j - j % 4 is the shared part of four neighbouring markers
            block = F.col("embedding")[j - j % 4].cast("double")
            b = block + F.lit(0.5) * (j % 4) * x.cast("double")
            limit = F.lit(0.005) * j
            missing = (F.col("vec_id") * 31 + j * 17) % 97 == 0
            return F.when(
                ~missing,
                F.when(b > F.lit(0.02) + limit, 2).when(b > F.lit(-0.1) + limit, 1).otherwise(0),
            ).cast("int")

        return self.raw("embeddings").select(
            F.col("vec_id").alias("s"), "label", F.transform("embedding", element).alias("dosages")
        )

    def genotypes(self) -> DataFrame:
        long = self.sample_dosages().select("s", F.posexplode("dosages").alias("j", "dosage"))
        j = F.col("j")
        return long.select(
            F.floor(j / 32 + 1).cast("bigint").alias("chrom"),
            (j * 1000).cast("bigint").alias("pos"),
            F.concat(F.lit("m"), j.cast("string")).alias("marker_id"),
            "s",
            "dosage",
        )

    def genotypes_with_alleles(self) -> DataFrame:
        """Long rows with ref and alt: six kinds of pairs in turn, two of them ambiguous."""
        kind = F.floor(F.col("pos") / 1000) % 6
        pick = lambda bases: F.element_at(F.array(*[F.lit(b) for b in bases]), (kind + 1).cast("int"))
        return self.genotypes().withColumns({"ref": pick("ACAGAC"), "alt": pick("GTCTTG")})

    def spread_genotypes(self) -> DataFrame:
        """The genotypes 60 times as far apart, so that a chromosome is longer than 1000 kb, and a third one of rare markers, 10 to 17 carriers each."""
        apart = self.genotypes().withColumn("pos", F.col("pos") * 60)
        s, k = F.col("vec_id"), F.col("k")
        rare = self.raw("embeddings").select(s, F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k")).select(
            F.lit(3).cast("bigint").alias("chrom"),
            (400_000 * (k + 1)).cast("bigint").alias("pos"),
            F.concat(F.lit("r"), k.cast("string")).alias("marker_id"),
            s.alias("s"),
            F.when(s.between(20 * k, 21 * k + 9), 1).otherwise(0).alias("dosage"),
        )
        return apart.unionByName(rare)

    def variant_rows(self) -> tuple[DataFrame, DataFrame]:
        """The genotypes as a stored table of variant rows, and their samples (sample_idx, s)."""
        samples = write_intermediate(variant_rows.sample_index(self.raw("embeddings").select(F.col("vec_id").alias("s"))), "samples")
        return write_intermediate(variant_rows.from_long(self.genotypes_with_alleles(), samples), "variant-rows"), samples

    def flagged_samples(self) -> DataFrame:
        return self.raw("embeddings").where("label = 0").select(F.col("vec_id").alias("s"))

    def genotype_phenotype(self) -> DataFrame:
        key = F.col("vec_id")
        return self.raw("embeddings").select(
            key.alias("s"),
            (F.col("label") < 3).cast("int").alias("y_binary"),
            (key % 101 + F.col("label")).cast("double").alias("y_quantitative"),
            (18 + key % 60).cast("double").alias("age"),
            (key % 2).cast("double").alias("sex"),
        )
