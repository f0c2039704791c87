"""op10: licence scans. Sliding comparisons are too slow in SQL; tests compare by brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..licenses import license_report
from .registry import query, table


@query("op10_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))
