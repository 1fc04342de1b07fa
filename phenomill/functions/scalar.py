"""Scalar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed age bins and their labels.
AGE_BINS = [0, 29, 39, 49, 59, 69, 79, 89, 200]
AGE_LABELS = ["18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80-89", "90+"]

# Concept ids of sex at birth.
FEMALE_CONCEPT = 45878463
MALE_CONCEPT = 45880669


def normalize_person_id(column: Column) -> Column:
    return F.trim(column.cast("string")).try_cast("bigint")


def age_group(age: Column) -> Column:
    """Label of the bin holding ``age``; the lowest edge is included, outside is NULL."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(AGE_BINS, AGE_BINS[1:], AGE_LABELS))):
        above = age >= low if low == AGE_BINS[0] else age > low
        label = F.when(above & (age <= high), F.lit(name)).otherwise(label)
    return label


def sex_code(concept_id: Column) -> Column:
    return (
        F.when(concept_id == FEMALE_CONCEPT, "F").when(concept_id == MALE_CONCEPT, "M").otherwise("0")
    )


def prefix_numeric_code(code: Column) -> Column:
    """``495`` -> ``phe_495``; decimals count as numeric, other codes stay."""
    return F.when(code.rlike(r"^\d+(\.\d+)?$"), F.concat(F.lit("phe_"), code)).otherwise(code)


def split_codes(text: Column) -> Column:
    """``"a, b"`` to an array of trimmed codes without empty or NaN entries."""
    parts = F.transform(F.split(text, ","), lambda c: F.trim(c))
    return F.filter(parts, lambda c: (c != "") & (c != "NaN"))


def prefix_code_list(text: Column) -> Column:
    return F.transform(split_codes(text), prefix_numeric_code)


def sex_flag(text: Column) -> Column:
    """``male`` / ``female`` in lower case, anything else ``FALSE``."""
    cleaned = F.lower(F.trim(text))
    return F.when(cleaned.isin("male", "female"), cleaned).otherwise("FALSE")


def cohort_tag(sex_specific_run: Column) -> Column:
    return F.when(
        sex_specific_run.isin("Male", "Female"), F.concat(F.lit("_"), F.lower(sex_specific_run))
    ).otherwise("")


def text_is_true(column: Column) -> Column:
    return F.coalesce(F.lower(column.cast("string")) == "true", F.lit(False))


def truncated(column: Column) -> Column:
    """Double to integer, cut toward zero.

    Rounding to nine places first makes a mean that is whole up to float noise
    independent of the order in which partitions were summed.
    """
    return F.round(column, 9).cast("bigint")


def neg_log10(column: Column) -> Column:
    return -F.log10(column)


def survey_short_name(name: Column) -> Column:
    """Family-history question text without its boilerplate."""
    lowered = F.lower(name)
    for phrase in ("including yourself, who in your family has had", "select all that apply."):
        lowered = F.replace(lowered, F.lit(phrase), F.lit(""))
    return lowered


def notebook_name(data_type: str, concept: Column) -> Column:
    text = concept.cast("string")
    if data_type == "physical_measurement":
        return F.concat(F.replace(F.lower(text), F.lit("-"), F.lit("_")), F.lit("_summary.ipynb"))
    if data_type == "lab":
        return F.concat(
            F.lit("measurement_"), F.replace(text, F.lit(", "), F.lit("_")), F.lit(".ipynb")
        )
    return F.concat(F.lit(data_type), F.lit("_"), text, F.lit("_summary.ipynb"))
