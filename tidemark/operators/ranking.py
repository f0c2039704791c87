"""Exact ranks within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_SLICE, _SIZE, _BEFORE, _LOCAL = "_slice", "_size", "_before", "_local"


def _offsets(staged: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows of the same group in earlier slices.

    Slices are contiguous, so there are at most (shuffle partitions + groups) rows here.
    """
    earlier = (
        Window.partitionBy(*groups)
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = staged.groupBy(*groups, _SLICE).agg(F.count("*").alias(_SIZE))
    return sizes.select(
        *[F.col(g).alias(f"_o_{g}") for g in groups],
        F.col(_SLICE).alias("_o_slice"),
        F.coalesce(F.sum(_SIZE).over(earlier), F.lit(0)).alias(_BEFORE),
    )


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[Column],
    name: str,
) -> DataFrame:
    """``row_number() over (partition by groups order by order_by)``, for large groups.

    A window partitioned by region puts a whole region into one task. Here the rows are
    range-partitioned on (groups, order), so a large group spans many slices; a row's
    rank is its position in its slice plus the sizes of the group's earlier slices.
    Slice ids are written out before they are used twice: the sampled range boundaries
    need not repeat when a lost stage runs again. ``order_by`` must order rows totally.
    """
    ranged = df.repartitionByRange(*[F.col(g) for g in groups], *order_by)
    staged = stage(ranged.withColumn(_SLICE, F.spark_partition_id()), "rank")
    position = Window.partitionBy(*groups, _SLICE).orderBy(*order_by)
    local = staged.withColumn(_LOCAL, F.row_number().over(position))
    offsets = _offsets(staged, groups)
    same = F.col(_SLICE) == F.col("_o_slice")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    return local.join(offsets, same).select(
        *df.columns, (F.col(_LOCAL) + F.col(_BEFORE)).cast("bigint").alias(name)
    )


def top_within(
    df: DataFrame, groups: Sequence[str], order_by: Sequence[Column], k: int, name: str
) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    Planned as a group limit before the shuffle, so a group's task receives at most
    ``k`` rows from each map task and no full ranking is needed. Spark plans it up to a
    threshold, which is raised where ``k`` is above it.
    """
    conf, setting = df.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(setting)) < k:
        conf.set(setting, k)
    window = Window.partitionBy(*groups).orderBy(*order_by)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return ranked.withColumn(name, F.col(name).cast("bigint"))
