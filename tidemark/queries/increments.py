"""Loads by bookmark into a catalog table, and Gold by the partitions they touch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.increments import refresh_gold, refresh_profile
from ..session import remove_path, scratch_dir
from ..sources.writers import create_database
from ..streaming.incremental import file_stream, ingest_into_table
from .registry import FACTS, category_reference, facts, mean_sql, query

LATEST = (
    FACTS
    + """, latest AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, region, trending_date_parsed
        ORDER BY l_orderkey DESC, l_linenumber DESC, views DESC, likes DESC) AS rn FROM facts) WHERE rn = 1)
"""
)
LATEST_NAMED = (
    LATEST
    + """, named AS (
      SELECT latest.*, coalesce(n_name, 'Unknown') AS category_name
      FROM latest LEFT JOIN nation ON category_id = n_nationkey)
"""
)


def _by_year(df: DataFrame) -> DataFrame:
    return df.withColumn("trending_year", F.year("trending_date_parsed"))


def _load(spark: SparkSession, sf_dir: str, *, gold: bool = False, checks: bool = False) -> str:
    """The database of a small lake: two pulls of files from different days, the second one repeated."""
    home, db = scratch_dir(spark, "lake"), f"lake_{uuid.uuid4().hex[:12]}"
    create_database(spark, db, f"{home}/{db}")
    landing, checkpoint = f"{home}/landing", f"{home}/checkpoint"
    rows = _by_year(facts(spark, sf_dir, videos=gold or checks))
    if checks:
        rows = rows.withColumns(
            {
                "title": F.when(F.col("l_linenumber") < 7, F.col("title")),
                "views": F.when(F.col("l_linenumber") == 2, F.lit(-1)).otherwise(F.col("views")).cast("bigint"),
            }
        )
    names = category_reference(spark, sf_dir)
    #: Columns of order lines and parts that statistics do not have; the first says which pull a row comes with.
    others = ("l_linestatus", "l_returnflag", "l_shipdate", "p_type", "p_brand")

    def pull() -> list[str]:
        return ingest_into_table(
            file_stream(spark, landing, "parquet", rows.drop(*others).schema),
            f"{db}.statistics",
            checkpoint,
            None,
            partition_cols=("region", "trending_year"),
            latest=("l_orderkey", "l_linenumber"),
            tie_break=[F.col("views").desc(), F.col("likes").desc()],
        )

    for status in (F.col("l_linestatus") == "F", F.col("l_linestatus") != "F"):
        rows.filter(status).drop(*others).write.mode("append").parquet(landing)
        pull()
        if gold:
            refresh_gold(spark, f"{db}.statistics", lambda name: f"{db}.{name}", names, partitioned=_by_year)
        if checks:
            refresh_profile(spark, f"{db}.statistics", f"{db}.profile")
    # A checkpoint that has lost the end of the last batch, as after a crash: the batch comes again.
    remove_path(spark, f"{checkpoint}/commits/1")
    if pull():
        raise RuntimeError("a batch was applied twice")
    return db


@query(
    "silver_bookmarked",
    f"""WITH {LATEST} SELECT region, year(trending_date_parsed) AS trending_year, COUNT(*) AS n,
      CAST(SUM(views) AS BIGINT) AS views, CAST(SUM(likes) AS BIGINT) AS likes FROM latest GROUP BY ALL""",
)
def silver_bookmarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table after two bookmarked pulls and a repeated batch."""
    stored = spark.table(f"{_load(spark, sf_dir)}.statistics")
    return stored.groupBy("region", "trending_year").agg(
        F.count("*").alias("n"), F.sum("views").alias("views"), F.sum("likes").alias("likes")
    )


@query(
    "gold_increment_channels",
    f"""WITH {LATEST_NAMED}, totals AS (
      SELECT channel_title, region, COUNT(DISTINCT video_id) AS total_videos,
        CAST(SUM(views) AS BIGINT) AS total_views, CAST(SUM(likes) AS BIGINT) AS total_likes,
        CAST(SUM(views) AS DOUBLE) / COUNT(views) AS avg_views_per_video,
        {mean_sql('engagement_rate')} AS avg_engagement_rate, MAX(views) AS peak_views,
        COUNT(trending_date_parsed) AS times_trending, MIN(trending_date_parsed) AS first_trending,
        MAX(trending_date_parsed) AS last_trending,
        array_to_string(list_sort(list(DISTINCT category_name)), '|') AS categories
      FROM named GROUP BY channel_title, region)
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title) AS rank_in_region
    FROM totals""",
)
def gold_increment_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channel mart after two increments, as a full build has it."""
    mart = spark.table(f"{_load(spark, sf_dir, gold=True)}.channel_analytics")
    return mart.drop("total_comments", "_aggregated_at").withColumn("categories", F.array_join("categories", "|"))


@query(
    "gold_increment_days",
    f"""WITH {LATEST_NAMED}, shares AS (
      SELECT category_name, category_id, region, trending_date_parsed, COUNT(video_id) AS video_count,
        CAST(SUM(views) AS BIGINT) AS total_views, COUNT(DISTINCT channel_title) AS unique_channels
      FROM named GROUP BY category_name, category_id, region, trending_date_parsed),
    days AS (
      SELECT region, trending_date_parsed, COUNT(video_id) AS day_videos, MAX(views) AS max_views,
        {mean_sql('like_ratio')} AS avg_like_ratio, COUNT(DISTINCT channel_title) AS day_channels
      FROM latest GROUP BY region, trending_date_parsed)
    SELECT shares.*, round(total_views / CAST(SUM(total_views) OVER (
        PARTITION BY region, trending_date_parsed) AS BIGINT) * 100, 2) AS view_share_pct,
      day_videos, max_views, avg_like_ratio, day_channels
    FROM shares JOIN days USING (region, trending_date_parsed)""",
)
def gold_increment_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily marts after two increments, as a full build has them."""
    db = _load(spark, sf_dir, gold=True)
    shares = spark.table(f"{db}.category_analytics")
    days = spark.table(f"{db}.trending_analytics").select(
        "region",
        "trending_date_parsed",
        F.col("total_videos").alias("day_videos"),
        "max_views",
        "avg_like_ratio",
        F.col("unique_channels").alias("day_channels"),
    )
    mart = shares.join(days, ["region", "trending_date_parsed"])
    return mart.drop("trending_year", "total_likes", "total_comments", "avg_engagement_rate", "_aggregated_at")


@query(
    "dq_by_partition",
    f"""WITH {LATEST.replace("FROM facts)", "FROM (SELECT * REPLACE (CASE WHEN l_linenumber < 7 THEN title END AS title, CASE WHEN l_linenumber = 2 THEN -1 ELSE views END AS views) FROM facts))")}
    SELECT 'row_count' AS "check", NULL AS "column", CAST(COUNT(*) AS DOUBLE) AS value, NULL AS negative_count,
      COUNT(*) >= 10 AS passed FROM latest
    UNION ALL SELECT 'null_pct', 'title', round(COUNT(*) FILTER (title IS NULL) / COUNT(*) * 100, 2), NULL,
      COUNT(*) FILTER (title IS NULL) / COUNT(*) <= 0.05 FROM latest
    UNION ALL SELECT 'value_range', 'views', NULL, COUNT(*) FILTER (views < 0), COUNT(*) FILTER (views < 0) = 0 FROM latest""",
)
def dq_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks on a table from counters of its partitions, after two pulls that touch some of them each."""
    db = _load(spark, sf_dir, checks=True)
    results = refresh_profile(spark, f"{db}.statistics", f"{db}.profile")
    wanted = F.col("check").isin("row_count", "value_range") | ((F.col("check") == "null_pct") & (F.col("column") == "title"))
    return results.filter(wanted).select("check", "column", "value", "negative_count", "passed")
