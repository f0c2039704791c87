"""The gated run: statistics and reference to Silver, checks, then Gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import quality
from ..operators.reference import ReferenceLoad
from ..sources import writers
from ..sources.catalog import read_optional
from .gold import run_silver_to_gold
from .silver import DAY_PARTITIONS, RunReport, run_bronze_to_silver, run_reference_load


@dataclass(frozen=True)
class Layers:
    """Where things are kept."""

    silver_db: str = "silver"
    gold_db: str = "gold"
    statistics: str = quality.STATISTICS
    reference: str = quality.REFERENCE
    results: str = "dq_results"
    root: str | None = None
    partition_cols: tuple[str, ...] = DAY_PARTITIONS
    thresholds: quality.Thresholds = field(default_factory=quality.Thresholds)

    def silver(self, name: str) -> str:
        return f"{self.silver_db}.{name}"

    def gold(self, name: str) -> str:
        return f"{self.gold_db}.{name}"

    def path(self, layer: str, name: str) -> str | None:
        return f"{self.root}/{layer}/{name}" if self.root else None


@dataclass(frozen=True)
class Outcome:
    silver: RunReport
    quality_passed: bool
    gold_built: bool


def gated(
    results: DataFrame, build: Sequence[DataFrame] | DataFrame
) -> DataFrame | Sequence[DataFrame] | None:
    """``build`` when all checks passed, else None."""
    return build if quality.quality_passed(results) else None


def run_medallion(
    spark: SparkSession,
    bronze: Sequence[DataFrame],
    reference: ReferenceLoad | None,
    layers: Layers,
    *,
    job_name: str,
    mode: str = "merge",
    as_of: Column | None = None,
) -> Outcome:
    """Run all stages; failing checks are stored in ``dq_results`` and stop before Gold.

    With the default ``mode`` each run adds its rows to Silver; Gold is built from all of Silver.
    """
    for db in (layers.silver_db, layers.gold_db):
        writers.create_database(spark, db)
    stats, ref = layers.silver(layers.statistics), layers.silver(layers.reference)
    report = run_bronze_to_silver(
        bronze,
        job_name=job_name,
        table=stats,
        path=layers.path("silver", layers.statistics),
        partition_cols=layers.partition_cols,
        mode=mode,
        as_of=as_of,
    )
    checked = {quality.STATISTICS: stats}
    if reference is not None:
        run_reference_load(
            reference, table=ref, path=layers.path("silver", layers.reference)
        )
        checked[quality.REFERENCE] = ref
    results = quality.check_tables(
        spark, checked, thresholds=layers.thresholds, as_of=as_of
    )
    stored = layers.silver(layers.results)
    writers.write_table(
        results,
        stored,
        path=layers.path("silver", layers.results),
        partition_cols=(),
        mode="overwrite",
    )
    passed = quality.quality_passed(spark.table(stored))
    built = passed and run_silver_to_gold(
        spark.table(stats),
        read_optional(spark, ref),
        path_of=(lambda name: layers.path("gold", name)) if layers.root else None,
        table_of=layers.gold,
        mode="partitions" if mode == "merge" else mode,
        as_of=as_of,
    )
    return Outcome(report, passed, built)
