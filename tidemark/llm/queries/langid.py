"""op5: language identification. SQL cannot express the training; tests measure held-out accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..langid import identify
from .registry import query, table


@query("op5_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
