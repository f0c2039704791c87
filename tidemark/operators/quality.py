"""Data-quality checks as rows, their summary, and the gate in front of Gold.

All value checks of a table come out of one aggregate over it; schema checks are decided
from column names while the plan is built.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..schemas import DQ_RESULTS
from ..sources.catalog import read_table

log = logging.getLogger(__name__)

STATISTICS, REFERENCE = "clean_statistics", "clean_reference_data"

# --- fixed values: default thresholds and critical columns ---------------------------
CRITICAL_COLUMNS = {
    STATISTICS: ["video_id", "title", "channel_title", "views", "region"],
    REFERENCE: ["id", "region"],
}
TIMESTAMP_COLUMNS = ["_processed_at", "_ingestion_timestamp"]


@dataclass(frozen=True)
class Thresholds:
    min_rows: int = 10
    max_null_pct: float = 5.0
    max_views: int = 50_000_000_000
    freshness_hours: int = 48
    critical: dict[str, list[str]] = field(default_factory=lambda: CRITICAL_COLUMNS)


def _message(given: dict[str, Column], note: Column | None) -> Column:
    """A check row in words: the check, then whatever it has found out, name by name, and a note."""
    found = [f.name for f in DQ_RESULTS.fields if f.name in given and f.name not in ("check", "table", "passed")]
    shown = {
        c: F.array_join(given[c], ",") if isinstance(DQ_RESULTS[c].dataType, T.ArrayType)
        else given[c].cast(DQ_RESULTS[c].dataType).cast("string")
        for c in found
    }
    # A value that is NULL leaves its part out.
    parts = [F.concat(F.lit(f"{c.replace('_', ' ')} "), shown[c]) for c in found]
    return F.concat_ws("; ", given["check"], *parts, *([] if note is None else [note]))


def _row(table: str, check: str, passed: Column, note: Column | None = None, **values: Column) -> Column:
    """One check row in the shape of the result table."""
    given = {"check": F.lit(check), "table": F.lit(table), "passed": passed, **values}
    given["message"] = _message(given, note)
    return F.struct(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in DQ_RESULTS.fields
        ]
    )


def _nulls_name(c: str) -> str:
    return f"nulls_{c}"


def _row_count(table: str, t: Thresholds) -> Column:
    n = F.col("n")
    return _row(table, "row_count", n >= t.min_rows, value=n, threshold=F.lit(t.min_rows))


def _null_pct(table: str, column: str, present: bool, t: Thresholds) -> Column:
    name = F.lit(column)
    if not present:
        return _row(table, "null_pct", F.lit(False), F.lit("not a column of the table"), column=name)
    pct = F.coalesce(F.try_divide(F.col(_nulls_name(column)), F.col("n")) * 100, F.lit(0.0))
    return _row(
        table, "null_pct", pct <= t.max_null_pct,
        column=name, value=F.round(pct, 2), threshold=F.lit(t.max_null_pct),
    )


def _schema(table: str, columns: Iterable[str], t: Thresholds) -> Column:
    missing = sorted(set(t.critical.get(table, [])) - set(columns))
    return _row(
        table, "schema", F.lit(not missing),
        missing_columns=F.array(*[F.lit(m) for m in missing]).cast("array<string>"),
    )


def _value_range(table: str, t: Thresholds) -> Column:
    low, high = F.col("views_negative"), F.col("views_extreme")
    return _row(
        table, "value_range", (low == 0) & (high == 0),
        F.lit(f"allowed 0 to {t.max_views}"),
        column=F.lit("views"), negative_count=low, extreme_count=high,
    )


def _freshness(table: str, has_timestamp: bool, as_of: Column, t: Thresholds) -> Column:
    if not has_timestamp:
        return _row(table, "freshness", F.lit(True), F.lit("skipped: no time of processing in the table"))
    latest, cutoff = F.col("latest"), dates.hours_before(as_of, t.freshness_hours)
    # Text that is no timestamp skips the check; an all-NULL column fails it.
    unreadable = latest.isNull() & (F.col("stamped") > 0)
    return _row(
        table, "freshness",
        F.when(unreadable, True).otherwise(F.coalesce(latest >= cutoff, F.lit(False))),
        F.when(unreadable, F.lit("skipped: times of processing cannot be read")),
        latest_record=latest, cutoff=cutoff,
    )


def profile_measures(df: DataFrame, table: str, t: Thresholds) -> list[Column]:
    """Counters that all value checks of a table are made from; those of parts of it can be merged."""
    measures = [F.count("*").alias("n")]
    critical = [c for c in t.critical.get(table, []) if c in df.columns]
    measures += [F.count_if(F.col(c).isNull()).alias(_nulls_name(c)) for c in critical]
    if _has_views(df, table):
        measures += [
            F.count_if(F.col("views") < 0).alias("views_negative"),
            F.count_if(F.col("views") > t.max_views).alias("views_extreme"),
        ]
    stamp = _stamp(df)
    if stamp:
        c = F.col(stamp)
        if isinstance(df.schema[stamp].dataType, T.StringType):
            read = F.try_to_timestamp(c)
        else:
            read = c.cast("timestamp")
        measures += [F.max(read).alias("latest"), F.count(c).alias("stamped")]
    return measures


def _has_views(df: DataFrame, table: str) -> bool:
    return table == STATISTICS and "views" in df.columns


def _stamp(df: DataFrame) -> str | None:
    return next((c for c in TIMESTAMP_COLUMNS if c in df.columns), None)


def merged_profile(profiles: DataFrame, measures: Iterable[str]) -> DataFrame:
    """The profile of a table from those of its parts."""
    return profiles.agg(
        *[(F.max(m) if m == "latest" else F.coalesce(F.sum(m), F.lit(0)).cast("bigint")).alias(m) for m in measures]
    )


def checks_of_profile(
    profile: DataFrame, df: DataFrame, table: str, *, thresholds: Thresholds | None = None, as_of: Column | None = None
) -> DataFrame:
    """Check rows from a profile of ``df``, of which only the columns are looked at."""
    t = thresholds or Thresholds()
    now = F.current_timestamp() if as_of is None else as_of
    critical = t.critical.get(table, [])
    rows = [_row_count(table, t)]
    rows += [_null_pct(table, c, c in df.columns, t) for c in critical]
    rows += [_schema(table, df.columns, t)]
    rows += [_value_range(table, t)] if _has_views(df, table) else []
    rows += [_freshness(table, _stamp(df) is not None, now, t)]
    return profile.select(F.inline(F.array(*rows)))


def run_checks(
    df: DataFrame,
    table: str,
    *,
    thresholds: Thresholds | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Check rows for one table: row_count, null_pct, schema, value_range, freshness."""
    t = thresholds or Thresholds()
    profile = df.agg(*profile_measures(df, table, t))
    return checks_of_profile(profile, df, table, thresholds=t, as_of=as_of)


def observed_checks(
    df: DataFrame, table: str, *, thresholds: Thresholds | None = None, as_of: Column | None = None
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` to be written, and its check rows once that has been done, without reading it again."""
    t = thresholds or Thresholds()
    counters, measures = Observation(table), profile_measures(df, table, t)
    empty = df.limit(0).agg(*measures)

    def checks() -> DataFrame:
        found = observed(counters)
        profile = empty if found is None else df.sparkSession.createDataFrame([tuple(found.values())], empty.schema)
        return checks_of_profile(profile, df, table, thresholds=t, as_of=as_of)

    return df.observe(counters, *measures), checks


def observed(counters: Observation) -> dict | None:
    """What an observation has collected; None if its part of the plan was not run, as that of an empty input."""
    try:
        return dict(counters.get)
    except Py4JJavaError as reason:
        # An assertion of Spark: it finds no row of counters to hand out.
        if "AssertionError" not in str(reason.java_exception):
            raise
        return None


def unreadable(spark: SparkSession, table: str, reason: str) -> DataFrame:
    row = _row(table, "read_table", F.lit(False), F.lit(reason))
    return spark.range(1).select(F.inline(F.array(row)))


def check_tables(
    spark: SparkSession,
    tables: dict[str, str],
    *,
    thresholds: Thresholds | None = None,
    as_of: Column | None = None,
    sample_limit: int | None = None,
    probe: bool = True,
) -> DataFrame:
    """Checks for several tables (check name -> table to read).

    A table that is missing gives a failed row, and the others are still checked. With ``probe`` each
    table is checked at once, by one aggregate with one row per check, so that this holds for a table
    whose files cannot be read as well; without, the result is a plan that has not run.
    ``sample_limit`` restricts the checks to that many arbitrary rows; default: all.
    """
    results = None
    for name, source in tables.items():
        try:
            df = read_table(spark, source, limit=sample_limit)
            checked = run_checks(df, name, thresholds=thresholds, as_of=as_of)
            if probe:
                checked = spark.createDataFrame(checked.collect(), checked.schema)
        except (PySparkException, Py4JJavaError) as reason:
            checked = unreadable(spark, name, str(reason).splitlines()[0])
        results = checked if results is None else results.unionByName(checked)
    if results is None:
        raise ValueError("no tables to check")
    return results


def summarize(results: DataFrame) -> DataFrame:
    """One row: quality_passed, checks_passed, checks_total, and all check rows."""
    return results.agg(
        F.bool_and("passed").alias("quality_passed"),
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count("*").alias("checks_total"),
        F.sort_array(F.collect_list(F.struct(*DQ_RESULTS.fieldNames()))).alias("details"),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed"))


def quality_passed(results: DataFrame) -> bool:
    """The gate's verdict; no checks at all is no pass."""
    verdict = results.agg(F.bool_and("passed").alias("ok")).first()["ok"]
    return bool(verdict)


# Columns the Silver job itself reports on.
PROFILED = ["video_id", "title", "channel_title", "views"]


def null_profile_names(columns: Iterable[str] = PROFILED) -> list[str]:
    return [*map(_nulls_name, columns), "negative_views"]


def null_profile_columns(columns: Iterable[str] = PROFILED) -> list[Column]:
    """Counters for nulls and negative views, for an aggregate or an Observation."""
    nulls = [F.count_if(F.col(c).isNull()).alias(_nulls_name(c)) for c in columns]
    return nulls + [F.count_if(F.col("views") < 0).alias("negative_views")]


def null_profile(df: DataFrame, columns: Iterable[str] = PROFILED) -> DataFrame:
    return df.agg(*null_profile_columns(columns))


def warn_on_profile(counts: dict[str, int]) -> list[str]:
    """Log a warning per non-zero counter; never blocks."""
    found = [f"{name}: {n}" for name, n in counts.items() if n]
    for line in found:
        log.warning("quality: %s", line)
    return found
