"""op1: repeated paragraphs cut from documents. SQL cannot express the cuts; tests compare by brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..paragraphs import repeat_report
from .registry import query, table


@query("op1_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))
