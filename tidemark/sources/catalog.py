"""Catalog-table readers."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from .files import in_regions, read_if_present


def stored_regions(spark: SparkSession, name: str, regions: Iterable[str], column: str = "region") -> list[str] | None:
    """How the catalog spells the regions that are wanted; None if it keeps no partitions by them."""
    if not any(c.name == column and c.isPartition for c in spark.catalog.listColumns(name)):
        return None
    wanted = {r.strip(WHITESPACE).lower() for r in regions}
    segment = F.regexp_extract("partition", rf"(?:^|/){column}=([^/]*)", 1)
    found = spark.sql(f"SHOW PARTITIONS {name}").select(segment).distinct().collect()
    return sorted(v for v in (unquote(r[0]) for r in found) if v.strip(WHITESPACE).lower() in wanted)


def read_table(
    spark: SparkSession,
    name: str,
    *,
    columns: list[str] | None = None,
    regions: Iterable[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Scan of a table or view, optionally projected, restricted to regions, or sampled.

    Regions are wanted however they are spelt. Of a table partitioned by region the catalog is asked for
    the spellings it has, and the scan is given these: a plain list, by which a catalog prunes partitions
    before any file is listed.
    """
    stored = None if regions is None else stored_regions(spark, name, regions)
    df = in_regions(spark.table(name), regions) if stored is None else spark.table(name).filter(F.col("region").isin(stored))
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def query_table(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def read_optional(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None when it is missing: an optional source must not stop a run."""
    return read_if_present(lambda: spark.table(name))
