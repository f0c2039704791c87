"""Silver to Gold: three marts from two narrow scans of Silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ..operators import marts
from ..operators.enrich import attach_category_names, category_lookup
from ..session import stage, staging
from ..sources import writers

MARTS = ("trending_analytics", "channel_analytics", "category_analytics")


@dataclass(frozen=True)
class Gold:
    trending_analytics: DataFrame
    channel_analytics: DataFrame
    category_analytics: DataFrame


def build_gold(
    stats: DataFrame, reference: DataFrame | None, as_of: Column | None = None
) -> Gold:
    """All marts. The daily grain is staged once and feeds two of them.

    A missing reference table, or one of unknown layout, makes categories ``Unknown``.
    """
    lookup = None if reference is None else category_lookup(reference)
    grain = stage(marts.daily_grain(stats), "grain")
    named = attach_category_names(grain, lookup)
    return Gold(
        marts.stamp_aggregation(marts.trending_from_grain(grain), as_of),
        marts.stamp_aggregation(marts.channel_analytics(stats, lookup), as_of),
        marts.stamp_aggregation(marts.category_from_grain(named), as_of),
    )


def run_silver_to_gold(
    stats: DataFrame,
    reference: DataFrame | None,
    *,
    path_of: Callable[[str], str] | None = None,
    table_of: Callable[[str], str] | None = None,
    mode: str = "partitions",
    as_of: Column | None = None,
) -> bool:
    """Build and write all marts; False, and nothing written, when Silver is empty.

    ``path_of`` and ``table_of`` map a mart's name to where it goes.
    """
    if stats.isEmpty():
        return False
    with staging(stats.sparkSession):
        gold = build_gold(stats, reference, as_of)
        for name in MARTS:
            mart = getattr(gold, name)
            path = path_of(name) if path_of else None
            if table_of:
                writers.write_table(mart, table_of(name), path=path, mode=mode)
            elif path:
                writers.write_parquet(mart, path, mode=mode)
            else:
                raise ValueError("give path_of or table_of")
    return True
