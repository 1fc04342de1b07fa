"""Missing-value rules.

NaN becomes NULL once on ingest; every flag below is null-safe, so a missing input
gives a definite True or False.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Replace NaN by NULL in the named columns, or in every float column."""
    names = columns or tuple(
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    )
    return df.withColumns({n: F.nanvl(F.col(f"`{n}`"), F.lit(None)) for n in names})


def true_or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """a != b where a missing side counts as different, even when both are missing."""
    return F.coalesce(a != b, F.lit(True))


def in_list(column: Column, values: list) -> Column:
    return true_or_false(column.isin(list(values)))


def not_in_list(column: Column, values: list) -> Column:
    """NOT IN that keeps rows with a missing value."""
    return column.isNull() | ~column.isin(list(values))


def to_number(column: Column) -> Column:
    """Text to double; unparsable text, 'NaN' and NaN become NULL."""
    return F.nanvl(column.try_cast("double"), F.lit(None).cast("double"))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys (still an equi-join for the optimizer)."""
    return reduce(
        lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys]
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which missing keys match each other; the keys of ``left`` are kept."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b,
        [F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`")) for k in keys],
    )
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{k}" for k in keys])
