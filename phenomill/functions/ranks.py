"""Ordering within groups without ever sorting one group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenomill.functions.nulls import join_null_safe
from phenomill.session import write_intermediate


def ordered_prefix(
    df: DataFrame, keys: list[str], order: list[str], weight: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Add ``__before`` (weight of the rows ahead within the group) and ``__total``.

    (keys, order) must be unique. The rows are range-partitioned on (keys, order), so a large
    group lies in many consecutive partitions of even size; sums per partition and group give
    the offsets. The partitioned rows are written once, because the sampled range bounds must
    be the same for the offsets and the rows.
    """
    amount = F.col(weight) if weight else F.lit(1)
    width = [partitions] if partitions else []
    spread = (
        df.repartitionByRange(*width, *[F.col(f"`{c}`") for c in [*keys, *order]])
        .withColumn("__part", F.spark_partition_id())
    )
    spread = write_intermediate(spread, "ordered")
    pieces = spread.groupBy(*keys, "__part").agg(F.sum(amount).alias("__piece"))
    # One row per group and partition the group touches.
    in_group = Window.partitionBy(*keys)
    pieces = pieces.select(
        *keys,
        "__part",
        (F.sum("__piece").over(in_group.orderBy("__part")) - F.col("__piece")).alias("__offset"),
        F.sum("__piece").over(in_group).alias("__total"),
    )
    in_piece = Window.partitionBy("__part", *keys).orderBy(*[F.col(f"`{c}`") for c in order])
    within = spread.withColumn("__running", F.sum(amount).over(in_piece) - amount)
    return (
        join_null_safe(within, pieces, ["__part", *keys], "inner")
        .withColumn("__before", F.col("__offset") + F.col("__running"))
        .drop("__running", "__offset", "__part")
    )


def expand_counts(df: DataFrame, count: str, index: str, chunk: int = 100_000) -> DataFrame:
    """Repeat each row ``count`` times with ``index`` = 0 .. count-1.

    A large count is first cut into chunks that are spread over the tasks.
    """
    chunked = df.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / chunk)))
    )
    spread = chunked.repartition("__chunk", *[F.col(f"`{c}`") for c in df.columns])
    return spread.withColumn(
        index,
        F.explode(
            F.sequence(
                F.col("__chunk") * chunk,
                F.least((F.col("__chunk") + 1) * chunk, F.col(count)) - 1,
            )
        ),
    ).drop("__chunk")


def top_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, spread_on: list[str], salts: int = 64
) -> DataFrame:
    """First ``n`` rows of each group in ``order``, which must be a total order.

    Each group is first cut to its best ``n`` within ``salts`` parts, so the last step sees at
    most ``n * salts`` rows of a group.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*spread_on), F.lit(salts)))
    in_part = Window.partitionBy(*keys, "__salt").orderBy(*order)
    in_group = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("__rn", F.row_number().over(in_part))
        .where(F.col("__rn") <= n)
        .withColumn("__rn", F.row_number().over(in_group))
        .where(F.col("__rn") <= n)
        .drop("__salt", "__rn")
    )
