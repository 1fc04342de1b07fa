"""Lab measurements: extraction, unit harmonization, quality flags, per-person summaries.

All operators work on every lab at once, keyed by concept or ``lab_name``. The dictionary
tables (metadata, unit map, unit factors, site drops) are joined without hints: Spark
broadcasts them while their measured size allows it and falls back to a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.functions.nulls import differs, in_list, join_null_safe, not_in_list, true_or_false
from phenomill.functions.quantiles import (
    exact_median,
    exact_percentiles,
    summarize,
    summarize_counts,
    value_counts,
)
from phenomill.functions.scalar import truncated
from phenomill.session import broadcast_checked, small_table, write_intermediate

CONTRACT = [
    "person_id",
    "measurement_concept_id",
    "src_id",
    "measurement_datetime",
    "standard_concept_name",
    "standard_concept_code",
    "standard_vocabulary",
    "unit_concept_name",
    "value_as_number",
    "operator_concept_name",
]
CLEAN_COLUMNS = [
    "src_id",
    "person_id",
    "standard_concept_name",
    "measurement_datetime",
    "lab_name",
    "value_as_number",
]

# Numbers that stand for "no value", and the unit text for a missing unit.
NAN_EQUIVALENTS = [10000000, 100000000]
NO_UNIT = "none"
SITE_PREFIX = "EHR site "

# Sites whose values are dropped, per lab (one or two concept ids).
SITES_TO_DROP = {
    "3019897": [537],
    "3024929": [310, 537, 609],
    "3008342": [537],
    "3013869": [250, 537],
    "3014576": [537],
    "3013682": [243, 250, 609],
    "3045716": [609],
    "3013721": [250],
    "3006923": [250],
    "3035995": [278, 609],
    "3007359": [321],
    "3027114": [243],
    "3009201": [144],
    "3015632": [250, 537, 609],
    "3018311": [250, 433, 537, 734],
    "3026910": [250, 930],
    "3016436": [412, 962],
    "3001420": [148, 250, 679],
    "3045440, 3023939": [734, 925],
    "3043359, 3027450": [433, 734, 925, 962],
    "3045792, 3016921": [734, 925],
    "3001008": [321, 497],
    "3035124": [194, 195, 321, 433, 497],
    "3035583": [194, 195, 250, 433, 397],
    "3022621": [250, 537],
}


# --- extraction -------------------------------------------------------------------------


def join_fact_ext(measurement: DataFrame, ext: DataFrame) -> DataFrame:
    return measurement.join(ext, "measurement_id")


CONCEPT_ROLES = ["measurement_concept_id", "operator_concept_id", "unit_concept_id", "value_as_concept_id"]


def join_concept_roles(facts: DataFrame, concept: DataFrame) -> DataFrame:
    """Attach concept names for the measurement, operator, unit and value roles. ``concept`` has one
    row per concept id.

    Where a dictionary is too large to be broadcast, facts without an id are spread by a second key, which the
    dictionary has as 0, so that missing ids aren't one hot key.
    """
    spread = F.xxhash64("person_id", "measurement_datetime", "value_as_number")

    def named(rows: DataFrame, key: str, **columns: str) -> DataFrame:
        role = concept.select(
            F.col("concept_id").alias(key), F.lit(0).cast("bigint").alias("__spread"), *[F.col(c).alias(new) for new, c in columns.items()]
        )
        rows = rows.withColumn("__spread", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0)).cast("bigint"))
        return rows.join(role, [key, "__spread"], "left").drop("__spread")

    facts = named(
        facts,
        "measurement_concept_id",
        standard_concept_name="concept_name",
        standard_concept_code="concept_code",
        standard_vocabulary="vocabulary_id",
    )
    for key in CONCEPT_ROLES[1:]:
        facts = named(facts, key, **{key.removesuffix("_id") + "_name": "concept_name"})
    return facts


def used_concepts(facts: DataFrame, concept: DataFrame) -> DataFrame:
    """The concepts that occur in any role, found in one pass over the four id columns: small enough to broadcast, unlike a
    full vocabulary, so the facts are not shuffled once per role."""
    ids = facts.select(F.explode(F.array(*CONCEPT_ROLES)).alias("concept_id")).where("concept_id IS NOT NULL").distinct()
    return write_intermediate(concept.join(ids, "concept_id", "left_semi"), "concepts")


def filter_concepts(df: DataFrame, concepts: list | DataFrame, column: str = "measurement_concept_id") -> DataFrame:
    """Keep listed concepts; the list is literal or a one-column table."""
    if isinstance(concepts, DataFrame):
        return df.join(concepts.select(F.col(concepts.columns[0]).alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(list(concepts)))


def scan_measurements(
    measurement: DataFrame, ext: DataFrame, concept: DataFrame, concepts: list | DataFrame
) -> DataFrame:
    """Distinct 17-column extract of the wanted measurement concepts.

    The concept ids stay in the result, so the rows are made distinct on ids and values before the
    names are attached: the wide text columns are never shuffled.
    """
    wanted = filter_concepts(measurement, concepts)
    concept = broadcast_checked(used_concepts(wanted, concept), 200)
    facts = (
        join_fact_ext(wanted, ext)
        .select(
            "person_id",
            "measurement_concept_id",
            "src_id",
            "measurement_datetime",
            "value_as_number",
            "unit_concept_id",
            "value_as_concept_id",
            "operator_concept_id",
            "measurement_source_concept_id",
            F.lower("measurement_source_value").alias("measurement_source_value"),
            F.lower("unit_source_value").alias("unit_source_value"),
        )
        .distinct()
    )
    return join_concept_roles(facts, concept).select(
        *CONTRACT,
        "unit_concept_id",
        "value_as_concept_id",
        F.lower("value_as_concept_name").alias("value_as_concept_name"),
        "operator_concept_id",
        "measurement_source_concept_id",
        "measurement_source_value",
        "unit_source_value",
    )


def project_contract(df: DataFrame, columns: list[str] = CONTRACT) -> DataFrame:
    if not set(columns) <= set(df.columns):
        raise ValueError(f"missing columns: {sorted(set(columns) - set(df.columns))}")
    return df.select(*columns)


# --- harmonization ----------------------------------------------------------------------


def join_metadata(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows of the labs in ``metadata`` with its columns; the name in the data wins."""
    return df.join(metadata.drop("standard_concept_name"), "measurement_concept_id")


def assign_unit(df: DataFrame, unit_map: DataFrame, order: str = "ord") -> DataFrame:
    """``assigned_unit``: the mapped unit when the raw one is in the map (even a missing target),
    else the raw unit; missing becomes ``none``. The last map entry of a raw unit wins.
    ``unit_rename_flag`` marks rows found in the map."""
    latest = unit_map.groupBy(F.col("assigned_unit").alias("unit_concept_name")).agg(
        F.max_by("reduced_unit", order).alias("__mapped"), F.lit(True).alias("__hit")
    )
    unit = F.when(F.col("__hit"), F.col("__mapped")).otherwise(F.col("unit_concept_name"))
    return (
        df.join(latest, "unit_concept_name", "left")
        .withColumn("assigned_unit", F.coalesce(unit, F.lit(NO_UNIT)))
        .withColumn("unit_rename_flag", true_or_false(F.col("__hit")))
        .drop("__mapped", "__hit")
    )


def classify_unit(df: DataFrame) -> DataFrame:
    return df.withColumn("classified_unit", F.col("assigned_unit"))


def join_unit_factors(df: DataFrame, unit_factors: DataFrame) -> DataFrame:
    factors = unit_factors.withColumnRenamed("assigned_unit", "classified_unit")
    return join_null_safe(df, factors, ["lab_name", "classified_unit", "standard_unit"], "left")


def convert_unit(df: DataFrame, unit_factors: DataFrame) -> DataFrame:
    """Multiply by the conversion factor. A factor of 0 leaves value and unit as they are; with no
    matching factor the unit becomes the standard one and the value missing."""
    factor = F.col("conversion_factor")
    unchanged = true_or_false(factor == 0)
    value = F.col("value_as_number")
    return join_unit_factors(df, unit_factors).withColumns(
        {
            "unedited_value_as_number": value,
            "final_unit": F.when(unchanged, F.col("classified_unit")).otherwise(F.col("standard_unit")),
            "value_as_number": F.when(unchanged, value).otherwise(value * factor),
        }
    )


def flag_measurements(
    df: DataFrame,
    unit_map: DataFrame | None = None,
    nan_equivalents: list[float] = NAN_EQUIVALENTS,
    check_raw: bool = False,
) -> DataFrame:
    """Seven quality flags, each True or False.

    The stand-ins for "no value" are looked for after conversion; ``check_raw`` also looks at the
    unedited value.
    """
    value = F.col("value_as_number")
    if "unit_rename_flag" not in df.columns:
        raw_units = unit_map.select(F.col("assigned_unit").alias("unit_concept_name")).distinct()
        df = df.join(raw_units.withColumn("__hit", F.lit(True)), "unit_concept_name", "left")
        df = df.withColumn("unit_rename_flag", true_or_false(F.col("__hit"))).drop("__hit")
    stands_for_missing = in_list(value, nan_equivalents)
    if check_raw:
        stands_for_missing = stands_for_missing | in_list(
            F.col("unedited_value_as_number"), nan_equivalents
        )
    return df.withColumns(
        {
            "nan_flag": value.isNull(),
            "nan_equiv_flag": stands_for_missing,
            "missing_value_flag": value.isNull() | stands_for_missing,
            "unit_none_flag": F.col("assigned_unit") == NO_UNIT,
            "unit_discord_flag": differs(F.col("final_unit"), F.col("standard_unit")),
            "outlier_flag": true_or_false(value < F.col("minimum_value"))
            | true_or_false(value > F.col("maximum_value")),
        }
    )


def harmonize(
    df: DataFrame,
    metadata: DataFrame,
    unit_map: DataFrame,
    unit_factors: DataFrame,
    nan_equivalents: list[float] = NAN_EQUIVALENTS,
    check_raw: bool = False,
) -> DataFrame:
    """Metadata join, unit mapping and conversion, flags: one narrow plan without a shuffle while
    the dictionaries fit a broadcast. ``metadata`` has one row per concept."""
    mapped = classify_unit(assign_unit(join_metadata(df, metadata), unit_map))
    return flag_measurements(
        convert_unit(mapped, unit_factors), nan_equivalents=nan_equivalents, check_raw=check_raw
    )


def is_clean():
    return ~(
        F.col("nan_flag") | F.col("nan_equiv_flag") | F.col("unit_discord_flag") | F.col("outlier_flag")
    )


def trim(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Rows without a disqualifying flag, in the clean seven-column form (plus ``keep``)."""
    return df.where(is_clean()).select(*keep, *CLEAN_COLUMNS, F.col("final_unit").alias("unit"))


def update_outlier_bounds(
    metadata: DataFrame,
    lab_name: str,
    minimum_value: float | None = None,
    maximum_value: float | None = None,
) -> DataFrame:
    """New bounds for the first row (lowest concept id) of a lab."""
    if minimum_value is None and maximum_value is None:
        raise ValueError("give minimum_value, maximum_value or both")
    of_lab = metadata.where(F.col("lab_name") == lab_name)
    if of_lab.isEmpty():
        raise ValueError(f"lab_name {lab_name!r} is not in the metadata")
    first = of_lab.agg(F.min("measurement_concept_id")).scalar()
    hit = (F.col("lab_name") == lab_name) & (F.col("measurement_concept_id") == first)
    bounds = {"minimum_value": minimum_value, "maximum_value": maximum_value}
    return metadata.withColumns(
        {
            name: F.when(hit, F.lit(float(new))).otherwise(F.col(name))
            for name, new in bounds.items()
            if new is not None
        }
    )


# --- site drops -------------------------------------------------------------------------


def site_names(sites: list) -> list[str]:
    """Bare site numbers get the prefix; prefixed names pass."""
    return [s if SITE_PREFIX in s else SITE_PREFIX + s for s in map(str, sites)]


def drop_sites(df: DataFrame, sites: list) -> DataFrame:
    return df.where(not_in_list(F.col("src_id"), site_names(sites)))


def dropped_value_count(df: DataFrame, sites: list) -> DataFrame:
    """Number of non-missing values that ``drop_sites`` removes."""
    return df.where(F.col("src_id").isin(site_names(sites))).agg(
        F.count("value_as_number").alias("dropped_values")
    )


def site_drop_table(spark, sites_by_lab: dict[str, list[int]] = SITES_TO_DROP) -> DataFrame:
    """(measurement_concept_id, src_id), one row per concept of a lab and site."""
    rows = [
        (int(concept), name)
        for lab, sites in sites_by_lab.items()
        for concept in lab.split(",")
        for name in site_names(sites)
    ]
    return small_table(spark, "measurement_concept_id bigint, src_id string", rows)


def drop_sites_by_concept(df: DataFrame, site_drops: DataFrame) -> DataFrame:
    """Drop the listed sites of every lab in one anti join; a missing site is kept."""
    return df.join(site_drops, ["measurement_concept_id", "src_id"], "left_anti")


# --- summaries --------------------------------------------------------------------------


def query_summary(df: DataFrame) -> DataFrame:
    """Rows, persons, sites and units per concept."""
    keys = ["standard_concept_name", "measurement_concept_id"]
    return (
        df.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("measurement_count"),
            F.countDistinct("person_id").alias("participant_count"),
            F.countDistinct("src_id").alias("site_count"),
            F.countDistinct("unit_concept_name").alias("unit_count"),
        )
    )


def units_dist(df: DataFrame, keys: list[str] = ("assigned_unit",), **limits) -> DataFrame:
    """Counts, flags and the distribution of unflagged values per unit."""
    keys = list(keys)
    value = F.when(~(F.col("missing_value_flag") | F.col("outlier_flag")), F.col("value_as_number"))
    counts = [
        F.countDistinct("person_id").alias("n_pids"),
        F.countDistinct("src_id").alias("n_ehr"),
        F.count(F.lit(1)).alias("total_meas"),
        F.count_if("missing_value_flag").alias("missing"),
        F.count("value_as_number").alias("meas_avail"),
        F.count_if("outlier_flag").alias("outliers"),
        F.min("conversion_factor").alias("conversion_factor"),
        F.count(value).alias("filtered_count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
    ]
    names = ["median", "percentile_01", "percentile_10", "percentile_75", "percentile_99"]
    stats = summarize(df, keys, value, [0.5, 0.01, 0.1, 0.75, 0.99], counts, few_groups=True, **limits)
    return stats.select(
        *[c for c in stats.columns if c != "pctl"],
        *[F.get("pctl", F.lit(i)).alias(n) for i, n in enumerate(names)],
    )


def percentile_agg(df: DataFrame, keys: list[str], value: str, probs: list[float], **limits) -> DataFrame:
    pctl = exact_percentiles(df, keys, value, probs, **limits)
    return pctl.select(
        *keys, *[F.col("pctl")[i].alias(f"percentile_{p * 100:02.0f}") for i, p in enumerate(probs)]
    )


def latest_per_person(df: DataFrame, keys: list[str] = ("person_id",)) -> DataFrame:
    """Value on the latest calendar date; the largest value when several share that date."""
    newest = F.max(F.struct(F.to_date("measurement_datetime").alias("d"), F.col("value_as_number").alias("v")))
    return (
        df.where(F.col("value_as_number").isNotNull() & F.col("measurement_datetime").isNotNull())
        .groupBy(*keys)
        .agg(newest.alias("__x"))
        .select(*keys, F.col("__x.v").alias("latest"))
    )


def person_summary(
    clean: DataFrame, keys: list[str] = ("person_id",), truncate: bool = True, **limits
) -> DataFrame:
    """min, median, max, mean, count and latest value per person (and lab), as integers cut toward
    zero unless ``truncate`` is off. Undated values count in all but ``latest``, which is NULL if all are undated."""
    keys = list(keys)
    value = F.col("value_as_number")
    rows = clean.where(value.isNotNull())
    dated = F.col("measurement_datetime").isNotNull()
    stats = summarize(
        rows,
        keys,
        value,
        [0.5],
        [
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.avg(value).alias("mean"),
            F.count(value).alias("count"),
            F.max(F.when(dated, F.struct(F.to_date("measurement_datetime").alias("d"), value.alias("v")))).alias("__latest"),
        ],
        **limits,
    ).select(
        *keys,
        "min",
        F.col("pctl")[0].alias("median"),
        "max",
        "mean",
        "count",
        F.col("__latest.v").alias("latest"),
    )
    if not truncate:
        return stats
    return stats.withColumns(
        {c: truncated(F.col(c)) for c in ("min", "median", "max", "mean", "latest")}
    )


def person_median(df: DataFrame, keys: list[str] = ("person_id",), **limits) -> DataFrame:
    return exact_median(df, list(keys), "value_as_number", **limits)


def sorted_units(df: DataFrame, column: str = "assigned_unit") -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def filter_histogram_range(
    df: DataFrame,
    value: str = "value_as_number",
    low: float = 0,
    high: float = 10000000,
    lab_name: str | None = None,
    unit: str | None = None,
    unit_column: str = "assigned_unit",
) -> DataFrame:
    out = df.where(F.col(value).between(low, high))
    if lab_name is not None:
        out = out.where(F.col("lab_name") == lab_name)
    if unit is not None:
        out = out.where(F.col(unit_column) == unit)
    if "missing_value_flag" in df.columns:
        out = out.where(~F.col("missing_value_flag"))
    return out


def histogram(
    df: DataFrame,
    keys: list[str] = ("lab_name", "assigned_unit"),
    value: str = "value_as_number",
    low: float = 0,
    high: float = 10000000,
    edges: int = 10,
) -> DataFrame:
    """Counts in ``edges - 1`` equal bins from 0 to the group's maximum; the last bin is closed."""
    keys, bins = list(keys), edges - 1
    counts = value_counts(filter_histogram_range(df, value, low, high), keys, value)
    top = counts.groupBy(*keys).agg(F.max(value).alias("__top"))
    width = F.col("__top") / F.lit(float(bins))
    bin_of = F.when(F.col("__top") > 0, F.least(F.floor(F.col(value) / width), F.lit(bins - 1))).otherwise(0)
    return (
        join_null_safe(counts, top, keys, "inner")
        .groupBy(*keys, bin_of.cast("bigint").alias("bin"))
        .agg(F.sum("__n").alias("frequency"), F.max("__top").alias("__top"))
        .select(
            *keys,
            "bin",
            (F.col("bin") * width).alias("bin_start"),
            ((F.col("bin") + 1) * width).alias("bin_end"),
            "frequency",
        )
    )


def boxplot_stats(
    df: DataFrame, state: str, fill: str, value: str = "value_as_number", **limits
) -> DataFrame:
    """Box summary per site and unit: quartiles, whiskers at 1.5 IQR, outlier count, and whether the
    value axis is logarithmic (overall maximum above ten times the mean)."""
    if state == "annotated":
        df = df.where(~F.col("missing_value_flag"))
    elif state != "final":
        raise ValueError(f"state is 'annotated' or 'final', not {state!r}")
    keys = ["src_id", fill]
    counts = write_intermediate(value_counts(df, keys, value), "box-values")
    overall = counts.agg(
        (F.max(value) > 10 * F.sum(F.col(value) * F.col("__n")) / F.sum("__n")).alias("use_log")
    ).scalar()
    boxes = summarize_counts(
        counts, keys, value, [0.25, 0.5, 0.75], [F.sum("__n").alias("n")], **limits
    ).select(
        *keys,
        "n",
        F.col("pctl")[0].alias("q1"),
        F.col("pctl")[1].alias("median"),
        F.col("pctl")[2].alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        join_null_safe(counts, boxes, keys, "inner")
        .groupBy(*keys)
        .agg(
            F.max("n").alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("__n"))).alias("n_outliers"),
        )
        .withColumn("use_log", overall)
    )


# --- HbA1c style cleaning ---------------------------------------------------------------

# Unit texts that cannot be used.
UNUSABLE_UNITS = [
    "No matching concept",
    "no value",
    "Percentage of total",
    "unit",
    "Seconds per CO",
    "gram per deciliter",
]


def exclude_units(df: DataFrame, units: list[str] = UNUSABLE_UNITS) -> DataFrame:
    return df.where(not_in_list(F.col("unit_concept_name"), units))


def convert_linear_unit(
    df: DataFrame, unit: str = "milligram per deciliter", offset: float = 46.7, divisor: float = 28.7
) -> DataFrame:
    value = F.col("value_as_number")
    return df.withColumn(
        "value_as_number",
        F.when(F.col("unit_concept_name") == unit, (value + offset) / divisor).otherwise(value),
    )


def filter_value_cap(df: DataFrame, cap: float = 50) -> DataFrame:
    return df.where(F.col("value_as_number") <= cap)
