"""Repair of delivered CSV files ahead of the Bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleanse import flag_repairs, repair_counts, repaired
from ..session import stage
from ..sources import files, writers


def run_csv_repair(
    spark: SparkSession, source: str, target: str, *, splittable: bool = True
) -> DataFrame:
    """Rewrite CSV under ``source`` cleanly to ``target``; returns counts per region.

    Files are in UTF-8 or ISO-8859-1, each as its bytes say. Multi-line CSV is costly to parse, so the
    tidied and flagged rows are staged once, and both the rewrite and the counts are taken from there.
    ``splittable=False`` gives each file to one task, and parses it once for each character set.
    """

    def read(path: str, encoding: str | None) -> DataFrame:
        return files.read_text_csv(spark, path, encoding=encoding)

    if splittable:
        raw = files.read_text_csv(spark, source, splittable=True)
    else:
        raw = files.read_any_charset(spark, source, read)
    flagged = stage(flag_repairs(raw), "repair")
    writers.write_repaired_csv(repaired(flagged), target)
    return repair_counts(flagged)
