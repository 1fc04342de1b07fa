"""Collects the queries over the driver's tables and the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenomill.plans.adapters import Tables
from phenomill.plans.oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, **replaced: str):
    """Register a function of ``Tables`` under its name, with the equivalent SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = with_views(sql, **replaced)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6, many: bool = False) -> DataFrame:
    """``many`` is for billions of rows: the same values, but Spark's round, which writes each number as decimal text, near ties and for large numbers only."""
    whole = {c: F.col(f"`{c}`").cast("double") for c in columns}
    return df.withColumns({c: _rounded_by_ties(x, places) if many else F.round(x, places) for c, x in whole.items()})


def _rounded_by_ties(x: Column, places: int) -> Column:
    # Below 1e11 the product is off by less than 2e-5, so beyond 1e-3 of a tie it has the same nearest whole number.
    scaled = x * F.lit(10.0**places)
    up = scaled + 0.5
    clear = (F.abs(scaled) < 1e11) & (F.abs(up - F.rint(up)) > 1e-3)
    return F.when(clear, F.floor(up).cast("double") / F.lit(10.0**places)).otherwise(F.round(x, places))
