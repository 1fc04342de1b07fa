"""Matching variants by their alleles, whatever the order and the strand they are written in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCUS = ["chrom", "pos"]
# The complementary bases.
BASES, COMPLEMENT = "ACGTacgt", "TGCAtgca"


def _other_strand(allele: Column) -> Column:
    """Complement of a sequence read from its other end."""
    return F.reverse(F.translate(allele, BASES, COMPLEMENT))


def _pair(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit("/"), b)


def allele_key(ref: str = "ref", alt: str = "alt") -> Column:
    """The same text for a pair of alleles, the swapped pair, and both on the other strand; in upper case."""
    r, a = F.upper(F.col(ref)), F.upper(F.col(alt))
    return F.least(_pair(r, a), _pair(a, r), _pair(_other_strand(r), _other_strand(a)), _pair(_other_strand(a), _other_strand(r)))


def is_ambiguous(ref: str = "ref", alt: str = "alt") -> Column:
    """A/T and C/G pairs (and longer ones) that look the same on the other strand when swapped."""
    return _other_strand(F.upper(F.col(ref))) == F.upper(F.col(alt))


def is_swapped(ref: str, alt: str, other_ref: str, other_alt: str) -> Column:
    """Whether two pairs of one ``allele_key`` count the copies of different alleles. Ambiguous pairs are taken for the same strand."""
    r, a, r2, a2 = (F.upper(F.col(c)) for c in (ref, alt, other_ref, other_alt))
    same = (r == r2) & (a == a2)
    swapped = (r == a2) & (a == r2)
    turned = (_other_strand(r) == a2) & (_other_strand(a) == r2)
    return F.when(same, False).when(swapped, True).otherwise(turned)


def join_alleles(left: DataFrame, right: DataFrame, values: list[str], how: str = "left", drop_ambiguous: bool = False) -> DataFrame:
    """``left`` with ``values`` of the ``right`` variant at the same locus that has the same alleles, and ``swapped``.

    ``swapped`` is true where right counts the copies of left's ref allele; a frequency f of right is then 1 - f for
    left, a dosage g is 2 - g. It is NULL without a match. Of variants that differ in order or strand only, right must have one. With
    ``drop_ambiguous`` pairs whose strand can't be told have no match.
    """
    key = [*LOCUS, "__alleles"]
    mine = left.withColumn("__alleles", allele_key())
    others = right.select(
        *LOCUS, allele_key().alias("__alleles"), F.col("ref").alias("__ref"), F.col("alt").alias("__alt"), *values
    )
    if drop_ambiguous:
        others = others.where(~is_ambiguous("__ref", "__alt"))
    joined = mine.join(others, key, how)
    swapped = F.when(F.col("__ref").isNotNull(), is_swapped("ref", "alt", "__ref", "__alt"))
    return joined.select(*left.columns, *values, swapped.alias("swapped"))
