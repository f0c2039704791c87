"""Quality checks, the gate, and run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, quality
from ..operators.cleanse import flag_repairs, repair_counts
from ..plans.medallion import gated
from ..session import stage
from ..sources.files import CORRUPT
from ..schemas import BRONZE_STATISTICS_COLUMNS
from .registry import FACTS, facts, query, table

AS_OF = "2001-11-05 00:00:00"  # the clock of these checks
N = len(BRONZE_STATISTICS_COLUMNS)

# Holes for the checks to find: titles, a negative and an excessive view count.
HOLES = (
    FACTS
    + """,
holed AS (
  SELECT video_id, CASE WHEN l_linenumber < 7 THEN title END AS title,
    CASE WHEN l_returnflag <> 'A' OR l_linenumber > 1 THEN channel_title END AS channel_title,
    CASE WHEN l_linenumber = 2 THEN -1 WHEN l_linenumber = 3 AND l_returnflag = 'R'
         THEN 50000000001 ELSE views END AS views,
    region, l_shipdate AS processed_at
  FROM facts)
"""
)


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    return facts(spark, sf_dir).select(
        "video_id",
        F.when(line < 7, F.col("title")).alias("title"),
        F.when((flag != "A") | (line > 1), F.col("channel_title")).alias("channel_title"),
        F.when(line == 2, F.lit(-1))
        .when((line == 3) & (flag == "R"), F.lit(50_000_000_001))
        .otherwise(F.col("views"))
        .cast("bigint")
        .alias("views"),
        "region",
        F.col("l_shipdate").cast("timestamp").alias("_processed_at"),
    )


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _checks(df: DataFrame, check: str, table: str = quality.STATISTICS) -> DataFrame:
    results = quality.run_checks(df, table, as_of=_as_of())
    return results.filter(F.col("check") == check)


@query(
    "dq_row_count",
    f"""WITH {HOLES} SELECT 'clean_statistics' AS "table", CAST(COUNT(*) AS DOUBLE) AS value,
      10.0::DOUBLE AS threshold, COUNT(*) >= 10 AS passed,
      'row_count; value ' || COUNT(*)::DOUBLE::VARCHAR || '; threshold 10.0' AS message FROM holed""",
)
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks(_holed(spark, sf_dir), "row_count").select(
        "table", "value", "threshold", "passed", "message"
    )


def _null_sql(column: str) -> str:
    pct = f"(SELECT COUNT(*) FILTER ({column} IS NULL) / COUNT(*) * 100 FROM holed)"
    return f"""SELECT '{column}' AS "column", round({pct}, 2) AS value,
      5.0::DOUBLE AS threshold, {pct} <= 5 AS passed,
      'null_pct; column {column}; value ' || round({pct}, 2)::VARCHAR || '; threshold 5.0' AS message"""


@query(
    "dq_null_pct",
    f"WITH {HOLES} "
    + " UNION ALL ".join(
        _null_sql(c) for c in quality.CRITICAL_COLUMNS[quality.STATISTICS]
    ),
)
def dq_null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks(_holed(spark, sf_dir), "null_pct").select(
        "column", "value", "threshold", "passed", "message"
    )


@query(
    "dq_schema",
    f"""WITH {HOLES} SELECT 'schema' AS "check", false AS passed,
      'region,title' AS missing_columns,
      'schema; missing columns region,title' AS message,
      CAST((SELECT COUNT(*) FROM holed WHERE views IS NOT NULL) AS DOUBLE) AS row_count""",
)
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = _holed(spark, sf_dir).drop("region", "title")
    results = quality.run_checks(partial, quality.STATISTICS, as_of=_as_of())
    counted = results.agg(
        *[
            F.max_by(c, F.col("check") == "schema").alias(c)
            for c in ("check", "passed", "message")
        ],
        F.array_join(F.max("missing_columns"), ",").alias("missing_columns"),
        F.max(F.when(F.col("check") == "row_count", F.col("value"))).alias("row_count"),
    )
    return counted.select("check", "passed", "missing_columns", "message", "row_count")


@query(
    "dq_value_range",
    f"""WITH {HOLES}, n AS (SELECT COUNT(*) FILTER (views < 0) AS low,
      COUNT(*) FILTER (views > 50000000000) AS high FROM holed)
    SELECT 'views' AS "column", low AS negative_count, high AS extreme_count,
      low = 0 AND high = 0 AS passed,
      'value_range; column views; negative count ' || low || '; extreme count ' || high ||
        '; allowed 0 to 50000000000' AS message
    FROM n""",
)
def dq_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks(_holed(spark, sf_dir), "value_range").select(
        "column", "negative_count", "extreme_count", "passed", "message"
    )


@query(
    "dq_freshness",
    f"""WITH {HOLES}, n AS (SELECT max(processed_at) AS latest,
      TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR AS cutoff FROM holed)
    SELECT strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest_record,
      strftime(cutoff, '%Y-%m-%d %H:%M:%S') AS cutoff, latest >= cutoff AS passed
    FROM n""",
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = "yyyy-MM-dd HH:mm:ss"
    return _checks(_holed(spark, sf_dir), "freshness").select(
        F.date_format("latest_record", shown).alias("latest_record"),
        F.date_format("cutoff", shown).alias("cutoff"),
        "passed",
    )


@query(
    "dq_summary",
    f"""WITH {HOLES}, checks AS (
      SELECT COUNT(*) >= 10 AS passed FROM holed
      UNION ALL SELECT COUNT(*) FILTER (video_id IS NULL) / COUNT(*) <= 0.05 FROM holed
      UNION ALL SELECT COUNT(*) FILTER (title IS NULL) / COUNT(*) <= 0.05 FROM holed
      UNION ALL SELECT COUNT(*) FILTER (channel_title IS NULL) / COUNT(*) <= 0.05 FROM holed
      UNION ALL SELECT COUNT(*) FILTER (views IS NULL) / COUNT(*) <= 0.05 FROM holed
      UNION ALL SELECT COUNT(*) FILTER (region IS NULL) / COUNT(*) <= 0.05 FROM holed
      UNION ALL SELECT true
      UNION ALL SELECT COUNT(*) FILTER (views < 0 OR views > 50000000000) = 0 FROM holed
      UNION ALL SELECT max(processed_at) >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR FROM holed
      UNION ALL SELECT false)
    SELECT bool_and(passed) AS quality_passed, COUNT(*) FILTER (passed) AS checks_passed,
      COUNT(*) AS checks_total, 'clean_reference_data' AS unreadable FROM checks""",
)
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables, of which the second does not exist."""
    _holed(spark, sf_dir).createOrReplaceTempView("tidemark_holed")
    results = quality.check_tables(
        spark,
        {quality.STATISTICS: "tidemark_holed", quality.REFERENCE: "tidemark_no_such_table"},
        as_of=_as_of(),
        probe=False,
    )
    missing = F.filter("details", lambda d: d["check"] == "read_table")
    return quality.summarize(results).select(
        "quality_passed",
        "checks_passed",
        "checks_total",
        missing[0]["table"].alias("unreadable"),
    )


@query(
    "dq_sample_scan",
    """SELECT CAST(least(COUNT(*), 10000) AS DOUBLE) AS value,
      least(COUNT(*), 10000) >= 10 AS passed FROM lineitem""",
)
def dq_sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling option of the checks: at most 10,000 arbitrary rows per table."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("tidemark_sampled")
    results = quality.check_tables(
        spark, {"lines": "tidemark_sampled"}, as_of=_as_of(), sample_limit=10_000, probe=False
    )
    return results.filter(F.col("check") == "row_count").select("value", "passed")


@query(
    "quality_gate_gold",
    f"""WITH {FACTS} SELECT 'good' AS variant, region, trending_date_parsed,
      COUNT(video_id) AS total_videos, CAST(SUM(views) AS BIGINT) AS total_views
    FROM facts WHERE (SELECT COUNT(*) >= 10 AND min(views) >= 0 FROM facts)
    GROUP BY region, trending_date_parsed""",
)
def quality_gate_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold for statistics that pass their checks, nothing for those that do not; the write counts for the checks."""
    good = facts(spark, sf_dir).select(
        "video_id", "title", "channel_title", "category_id", "region", "trending_date_parsed", "views", "likes",
        "dislikes", "comment_count", "like_ratio", "engagement_rate", "l_linenumber",
    )
    variants = {
        "good": good,
        "bad": good.withColumn(
            "views", F.when(F.col("l_linenumber") == 1, -1).otherwise(F.col("views"))
        ),
    }
    built = None
    for variant, stats in variants.items():
        watched, checks = quality.observed_checks(stats, quality.STATISTICS, as_of=_as_of())
        silver = stage(watched, "gate-silver")
        mart = marts.trending_analytics(silver).select(
            F.lit(variant).alias("variant"),
            "region", "trending_date_parsed", "total_videos", "total_views",
        )
        allowed = gated(checks(), mart)
        allowed = mart.limit(0) if allowed is None else allowed
        built = allowed if built is None else built.unionByName(allowed)
    return built


@query(
    "null_profile",
    f"""WITH {HOLES} SELECT COUNT(*) FILTER (video_id IS NULL) AS nulls_video_id,
      COUNT(*) FILTER (title IS NULL) AS nulls_title,
      COUNT(*) FILTER (channel_title IS NULL) AS nulls_channel_title,
      COUNT(*) FILTER (views IS NULL) AS nulls_views,
      COUNT(*) FILTER (views < 0) AS negative_views FROM holed""",
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(_holed(spark, sf_dir))


@query(
    "run_metrics",
    f"""WITH {FACTS} SELECT region,
      COUNT(*) FILTER (l_linenumber <> 6) AS rows_before,
      COUNT(*) FILTER (l_linenumber = 6) AS lines_skipped,
      COUNT(*) FILTER (l_linenumber = 5) AS rows_dropped,
      COUNT(*) FILTER (l_linenumber < 5 OR l_linenumber = 7) AS rows_after
    FROM facts GROUP BY region""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair counters over text rows, some malformed and some without a category number."""
    line = F.col("l_linenumber")
    values = {c: F.lit("x") for c in BRONZE_STATISTICS_COLUMNS}
    values["video_id"] = F.col("video_id")
    values["category_id"] = F.when(line == 5, "Music").otherwise(line.cast("string"))
    record = F.concat(F.lit('"a,b"'), F.repeat(F.lit(","), F.lit(N)))
    raw = facts(spark, sf_dir, videos=False).select(
        *[v.alias(c) for c, v in values.items()],
        "region",
        F.when(line == 6, record).alias(CORRUPT),
    )
    return repair_counts(flag_repairs(raw))
