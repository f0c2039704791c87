"""op6: bytes of repeated 200-byte strings removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..suffixes import remove_repeated
from .registry import query, table


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(table(spark, sf_dir, "documents"))
