"""Association results: filters, order, hits, release form and QQ data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.functions.nulls import to_number
from phenomill.functions.quantiles import exact_median
from phenomill.functions.ranks import expand_counts, ordered_prefix, top_n_per_group
from phenomill.functions.scalar import neg_log10, sex_flag
from phenomill.operators.catalogue import explode_phecodes, lookup_join

RESULT_KEYS = ["Ancestry", "Trait", "VariantClass"]
# Columns of a released result file, in order.
RELEASE_COLUMNS = [
    "MarkerID",
    "AC_Allele2",
    "p.value",
    "BETA",
    "SE",
    "Is.SPA",
    "Tstat",
    "var",
    "N",
    "N_case",
    "N_ctrl",
    "Ancestry",
    "Trait",
    "phecode",
    "VariantClass",
    "Sex_Specific",
]
P_VALUE = "`p.value`"


def concat_results(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def filter_results(
    df: DataFrame, min_ac: float = 10, min_cases: float = 100, max_af: float = 0.5
) -> DataFrame:
    """Allele count filter for all rows; case count and frequency filters only for rows of files
    that have the column (``has_n_case``, ``has_af``)."""
    cases, af = to_number(F.col("N_case")), to_number(F.col("AF_Allele2"))
    return df.withColumns({"N_case": cases, "AF_Allele2": af}).where(
        (F.col("AC_Allele2") >= min_ac)
        & (~F.col("has_n_case") | (F.col("N_case") >= min_cases))
        & (~F.col("has_af") | (F.col("AF_Allele2") < max_af))
    )


def sort_results(df: DataFrame) -> DataFrame:
    """Ascending by p-value, unparsable last; a range-partitioned sort."""
    return df.withColumn("p.value", to_number(F.col(P_VALUE))).orderBy(F.col(P_VALUE).asc_nulls_last())


def hits(df: DataFrame, threshold: float = 1e-7) -> DataFrame:
    return df.where(F.col(P_VALUE) < threshold)


def top_hits(df: DataFrame, k: int = 10, keys: list[str] = ("Trait",)) -> DataFrame:
    """Best ``k`` rows per trait by p-value, then marker, ancestry and class."""
    order = [F.col(P_VALUE).asc_nulls_last(), F.col("MarkerID"), F.col("Ancestry"), F.col("VariantClass")]
    return top_n_per_group(df, list(keys), order, k, ["MarkerID", "Ancestry", "VariantClass"])


def filter_high_af(df: DataFrame, min_af: float = 0.5) -> DataFrame:
    """High-frequency rows of files that have both marker and frequency columns."""
    has_columns = F.col("has_marker") & F.col("has_af")
    return df.where(has_columns & (to_number(F.col("AF_Allele2")) >= min_af))


def distinct_combos(df: DataFrame) -> DataFrame:
    return df.select(F.col("MarkerID").alias("Gene"), "Ancestry", "VariantClass").distinct()


def censor_small_counts(count: Column, limit: int = 40) -> Column:
    """Counts under the limit as ``<limit``, others as integer text, missing stays missing."""
    return F.when(count < limit, f"<{limit}").otherwise(count.cast("bigint").cast("string"))


def censor_results(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Release form: phenotype names for phecodes, sex restriction, small counts censored."""
    codes = explode_phecodes(catalogue).select(
        "phecode", "phenotype_ID", sex_flag(F.col("sex_specific_run")).alias("sex")
    )
    named = lookup_join(
        df.withColumn("phecode", F.col("Trait")),
        codes,
        "phecode",
        "phenotype_ID",
        "Trait",
        F.coalesce("phecode", F.lit("UNKNOWN")),
    )
    flagged = lookup_join(named, codes, "phecode", "sex", "Sex_Specific", F.lit("FALSE"))
    return flagged.withColumn("AC_Allele2", censor_small_counts(F.col("AC_Allele2"))).select(
        *[F.col(f"`{c}`") for c in RELEASE_COLUMNS]
    )


def qq_points(df: DataFrame, keys: list[str] = RESULT_KEYS, max_af: float = 0.5) -> DataFrame:
    """Expected and observed -log10 p per result set.

    Equal p-values are counted first; the ranks of the distinct ones come from a range-partitioned
    order, so neither a large result set nor a much repeated p-value meets in one task.
    """
    p = F.col(P_VALUE)
    keys = list(keys)
    distinct = (
        df.where((F.col("AF_Allele2") < max_af) & p.isNotNull())
        .groupBy(*keys, p.alias("p"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranked = ordered_prefix(distinct, keys, ["p"], "__n")
    points = expand_counts(ranked, "__n", "__i")
    rank = F.col("__before") + F.col("__i") + 1
    return points.select(
        *keys,
        rank.cast("bigint").alias("rank"),
        neg_log10(rank / (F.col("__total") + 1)).alias("expected"),
        neg_log10(F.col("p")).alias("observed"),
    )


def median_n_case(df: DataFrame, keys: list[str] = RESULT_KEYS) -> DataFrame:
    return exact_median(df.where(F.col("AF_Allele2") < 0.5), list(keys), "N_case", "median_n_case")
