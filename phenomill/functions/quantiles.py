"""Exact percentiles per group that stay bounded for very large groups.

``percentile`` keeps a value -> count map of its whole group in one task. ``summarize`` therefore
looks at the group sizes first (one pass over the key columns, combined before its shuffle):

* no group above ``max_group_rows``: one group-by;
* larger groups: their rows are reduced to (keys, value, count), which spreads a group over all
  tasks. Up to ``max_map_values`` distinct values, ``percentile`` takes the counts as weights;
* beyond that, (keys, value) are range-partitioned and each value's rank follows from the counts
  before it, so no group is ever in one task, whatever its size.

All three interpolate by the same formula, so a result doesn't depend on the way it was found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.functions.nulls import join_null_safe
from phenomill.functions.ranks import ordered_prefix
from phenomill.session import write_intermediate

MAX_GROUP_ROWS = 250_000
MAX_MAP_VALUES = 1_000_000


def value_counts(df: DataFrame, keys: list[str], value: str | Column, name: str | None = None) -> DataFrame:
    """(keys, value) with the number of rows ``__n``; missing values are dropped."""
    column = F.col(value) if isinstance(value, str) else value
    named = df.select(*keys, column.alias(name or value)).where(F.col(name or value).isNotNull())
    return named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("__n"))


def summarize(
    df: DataFrame,
    keys: list[str],
    value: str | Column,
    probs: list[float],
    aggs: list[Column] = (),
    out: str = "pctl",
    sized_by: DataFrame | None = None,
    few_groups: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    max_map_values: int = MAX_MAP_VALUES,
) -> DataFrame:
    """One row per group: ``aggs`` (aggregates of constant state) and ``out``, the array of linearly
    interpolated percentiles of ``value`` in the order of ``probs``.

    ``sized_by`` is a cheaper frame with at least the rows of ``df`` to take the sizes from. With
    ``few_groups`` all groups count as large and no sizes are taken.
    """
    column = F.col(value) if isinstance(value, str) else value

    def by_counts(rows: DataFrame) -> DataFrame:
        counted = summarize_counts(
            value_counts(rows, keys, column, "__v"), keys, "__v", probs, out=out, max_map_values=max_map_values
        )
        if not aggs:
            return counted
        return join_null_safe(rows.groupBy(*keys).agg(*aggs), counted, keys, "left")

    if few_groups:
        return by_counts(df)
    sizes = (
        (df if sized_by is None else sized_by)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > max_group_rows)
    )
    if sizes.isEmpty():
        return df.groupBy(*keys).agg(*aggs, F.percentile(column, _array(probs)).alias(out))
    large = write_intermediate(sizes.select(*keys), "large-groups")
    small = join_null_safe(df, large, keys, "left_anti")
    big = join_null_safe(df, large, keys, "left_semi")
    usual = small.groupBy(*keys).agg(*aggs, F.percentile(column, _array(probs)).alias(out))
    return usual.unionByName(by_counts(big))


def summarize_counts(
    counts: DataFrame,
    keys: list[str],
    value: str,
    probs: list[float],
    aggs: list[Column] = (),
    out: str = "pctl",
    max_map_values: int = MAX_MAP_VALUES,
) -> DataFrame:
    """The same from rows (keys, value, __n); ``aggs`` are built on ``value`` and ``__n``. The counts
    are written once, as they are read several times."""

    def weighted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*aggs, F.percentile(value, _array(probs), F.col("__n")).alias(out))

    counts = write_intermediate(counts, "value-counts")
    sizes = (
        counts.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > max_map_values)
    )
    if sizes.isEmpty():
        return weighted(counts)
    large = write_intermediate(sizes.select(*keys), "large-groups")
    usual = weighted(join_null_safe(counts, large, keys, "left_anti"))
    rows = join_null_safe(counts, large, keys, "left_semi")
    ranged = _percentiles_by_ranks(rows, keys, value, probs, out)
    if aggs:
        ranged = join_null_safe(rows.groupBy(*keys).agg(*aggs), ranged, keys, "inner")
    return usual.unionByName(ranged)


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str | Column, probs: list[float], out: str = "pctl", **limits
) -> DataFrame:
    """Linearly interpolated percentiles per group as an array column."""
    return summarize(df, keys, value, probs, out=out, **limits)


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median", **limits) -> DataFrame:
    """Median per group with at least one value."""
    return (
        exact_percentiles(df, keys, value, [0.5], "__p", **limits)
        .where(F.col("__p").isNotNull())
        .select(*keys, F.col("__p")[0].alias(out))
    )


def _array(probs: list[float]) -> Column:
    return F.array(*[F.lit(float(p)) for p in probs])


def _percentiles_by_ranks(rows: DataFrame, keys: list[str], value: str, probs: list[float], out: str) -> DataFrame:
    """``rows``: (keys, value, __n) of large groups. Same arithmetic as ``percentile``."""
    ranked = ordered_prefix(rows.select(*keys, value, "__n"), keys, [value], "__n")
    places = [(F.col("__total") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.array_distinct(F.array(*[f(r).cast("bigint") for r in places for f in (F.floor, F.ceil)]))
    inside = F.filter(wanted, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__n")))
    hits = ranked.select(*keys, "__total", value, F.explode(inside).alias("__rank"))
    at_rank = hits.groupBy(*keys).agg(
        F.max("__total").alias("__total"),
        F.map_from_entries(F.collect_set(F.struct("__rank", value))).alias("__at"),
    )
    results = []
    for p in probs:
        rank = (F.col("__total") - 1) * F.lit(float(p))
        below, above = F.floor(rank), F.ceil(rank)
        low = F.col("__at")[below.cast("bigint")].cast("double")
        high = F.col("__at")[above.cast("bigint")].cast("double")
        results.append(F.when(low == high, low).otherwise((above - rank) * low + (rank - below) * high))
    return at_rank.select(*keys, F.array(*results).alias(out))
