"""Bronze to Silver: one lazy plan, one action, counters collected on the way."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.cleanse import cleanse, derive, stamp_run
from ..operators.dedup import dedup_latest
from ..operators.normalize import INGEST_ORDER, unify
from ..operators.quality import null_profile_columns, null_profile_names, observed, warn_on_profile
from ..operators.reference import ReferenceLoad
from ..schemas import DEDUP_KEYS, SILVER_COLUMNS
from ..session import stage, staging
from ..sources import versions, writers
from ..streaming.incremental import merge_into_path, merged_with_table

#: Silver is kept by day, so that a run rewrites no more than the days it brings.
DAY_PARTITIONS = ("region", "trending_date_parsed")


@dataclass(frozen=True)
class RunReport:
    rows_read: int
    rows_written: int
    profile: dict[str, int]

    @property
    def rows_removed(self) -> int:
        return self.rows_read - self.rows_written


def clean_statistics(
    *bronze: DataFrame,
    job_name: str,
    as_of: Column | None = None,
    deduplicate: bool = True,
) -> DataFrame:
    """Silver statistics from Bronze frames of any shape."""
    rows = stamp_run(derive(cleanse(unify(*bronze, as_of=as_of))), job_name, as_of)
    if deduplicate:
        rows = dedup_latest(rows, DEDUP_KEYS, latest=("_processed_at", INGEST_ORDER))
    return rows.select(*SILVER_COLUMNS)


def run_bronze_to_silver(
    bronze: Sequence[DataFrame],
    *,
    job_name: str,
    path: str | None = None,
    table: str | None = None,
    partition_cols: Sequence[str] = DAY_PARTITIONS,
    mode: str = "merge",
    as_of: Column | None = None,
    run_id: str | None = None,
) -> RunReport:
    """Clean and write; with no input rows nothing is written.

    ``mode="merge"`` adds to what is stored: the partitions the run touches become the latest
    rows of what they held and what is new. A table is merged into through ``sources.versions``, so a
    crash loses nothing and a run with the ``run_id`` of an earlier one does nothing; a path is
    merged into through a complete copy beside it. A table keeps the partitions it was made with.
    The other modes are those of ``writers``; ``partitions`` replaces every partition the run brings
    by its rows alone.

    Row counts and the null profile are observed by the write itself, so the input is
    read once.
    """
    if all(df.isEmpty() for df in bronze):
        return RunReport(0, 0, {})
    seen, kept = Observation("bronze"), Observation("silver")
    # The rows read are the normalised rows, before any is dropped: an API document
    # counts once per video in it.
    rows = unify(*bronze, as_of=as_of).observe(seen, F.count("*").alias("rows_read"))
    rows = stamp_run(derive(cleanse(rows)), job_name, as_of)
    rows = dedup_latest(rows, DEDUP_KEYS, latest=("_processed_at", INGEST_ORDER))
    rows = rows.select(*SILVER_COLUMNS).observe(
        kept, F.count("*").alias("rows_written"), *null_profile_columns()
    )
    with staging(rows.sparkSession):
        if mode != "merge":
            _write(rows, path, table, partition_cols, mode)
        elif table:
            spark, latest = rows.sparkSession, ("_processed_at",)
            if not merged_with_table(
                spark, table, lambda: rows, rows.schema, partition_cols, DEDUP_KEYS, latest, run_id=run_id, path=path
            ):
                return RunReport(0, 0, {})
        elif path:
            merge_into_path(rows, path, partition_cols=partition_cols, keys=DEDUP_KEYS, latest=("_processed_at",))
        else:
            raise ValueError("give a path or a table to write to")
    counts = observed(kept)
    if counts is None:
        # Nothing survived, and the planner dropped the counters with the empty plan.
        counts = {"rows_written": 0, **dict.fromkeys(null_profile_names(), 0)}
    read = observed(seen) or {"rows_read": unify(*bronze, as_of=as_of).count()}
    written = counts.pop("rows_written")
    warn_on_profile(counts)
    return RunReport(read["rows_read"], written, counts)


def run_reference_load(
    load: ReferenceLoad, *, path: str | None = None, table: str | None = None
) -> None:
    """Store reference rows, replacing exactly the regions that were loaded."""
    _write(load.rows, path, table, ("region",), "partitions")


def _write(
    df: DataFrame, path: str | None, table: str | None, cols: Sequence[str], mode: str
) -> None:
    if table:
        writers.write_table(df, table, path=path, partition_cols=cols, mode=mode)
    elif path:
        writers.write_parquet(df, path, partition_cols=cols, mode=mode)
    else:
        raise ValueError("give a path or a table to write to")
