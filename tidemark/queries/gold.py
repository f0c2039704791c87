"""Marts, enrichment and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts
from ..operators.enrich import attach_category_names, category_lookup
from .registry import FACTS, NAMED, category_reference, facts, mean_sql, query, table

TRENDING_COLUMNS = f"""
  region, trending_date_parsed, COUNT(video_id) AS total_videos,
  CAST(SUM(views) AS BIGINT) AS total_views, CAST(SUM(likes) AS BIGINT) AS total_likes,
  CAST(SUM(dislikes) AS BIGINT) AS total_dislikes,
  CAST(SUM(comment_count) AS BIGINT) AS total_comments,
  CAST(SUM(views) AS DOUBLE) / COUNT(views) AS avg_views_per_video,
  {mean_sql('like_ratio')} AS avg_like_ratio,
  {mean_sql('engagement_rate')} AS avg_engagement_rate,
  MAX(views) AS max_views, COUNT(DISTINCT channel_title) AS unique_channels,
  COUNT(DISTINCT category_id) AS unique_categories
"""


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    return category_lookup(category_reference(spark, sf_dir))


@query(
    "trending_analytics",
    f"WITH {FACTS} SELECT {TRENDING_COLUMNS} FROM facts GROUP BY ALL",
)
def trending_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.trending_analytics(facts(spark, sf_dir))


@query(
    "channel_analytics",
    f"""WITH {NAMED}, totals AS (
      SELECT channel_title, region, COUNT(DISTINCT video_id) AS total_videos,
        CAST(SUM(views) AS BIGINT) AS total_views,
        CAST(SUM(likes) AS BIGINT) AS total_likes,
        CAST(SUM(comment_count) AS BIGINT) AS total_comments,
        CAST(SUM(views) AS DOUBLE) / COUNT(views) AS avg_views_per_video,
        {mean_sql('engagement_rate')} AS avg_engagement_rate,
        MAX(views) AS peak_views, COUNT(trending_date_parsed) AS times_trending,
        MIN(trending_date_parsed) AS first_trending,
        MAX(trending_date_parsed) AS last_trending,
        array_to_string(list_sort(list(DISTINCT category_name)), '|') AS categories
      FROM named GROUP BY channel_title, region)
    SELECT *, row_number() OVER (
      PARTITION BY region ORDER BY total_views DESC, channel_title) AS rank_in_region
    FROM totals""",
)
def channel_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.channel_analytics(facts(spark, sf_dir), _lookup(spark, sf_dir))
    return mart.withColumn("categories", F.array_join("categories", "|"))


@query(
    "category_analytics",
    f"""WITH {NAMED}, totals AS (
      SELECT category_name, category_id, region, trending_date_parsed,
        COUNT(video_id) AS video_count, CAST(SUM(views) AS BIGINT) AS total_views,
        CAST(SUM(likes) AS BIGINT) AS total_likes,
        CAST(SUM(comment_count) AS BIGINT) AS total_comments,
        {mean_sql('engagement_rate')} AS avg_engagement_rate,
        COUNT(DISTINCT channel_title) AS unique_channels
      FROM named GROUP BY category_name, category_id, region, trending_date_parsed)
    SELECT *, round(total_views / CAST(SUM(total_views) OVER (
      PARTITION BY region, trending_date_parsed) AS BIGINT) * 100, 2) AS view_share_pct
    FROM totals""",
)
def category_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.category_analytics(facts(spark, sf_dir), _lookup(spark, sf_dir))


@query(
    "top_channels_by_region",
    f"""WITH {FACTS}, totals AS (
      SELECT region, channel_title, CAST(SUM(views) AS BIGINT) AS total_views
      FROM facts GROUP BY region, channel_title)
    SELECT * FROM (
      SELECT *, row_number() OVER (
        PARTITION BY region ORDER BY total_views DESC, channel_title) AS rank_in_region
      FROM totals) WHERE rank_in_region <= 3""",
)
def top_channels_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = facts(spark, sf_dir, videos=False).groupBy("region", "channel_title").agg(
        F.sum("views").alias("total_views")
    )
    return marts.top_channels_by_region(totals, 3)


@query(
    "enrich_left_broadcast",
    f"""WITH {NAMED} SELECT video_id, region, category_id, category_name,
      trending_date_parsed, views FROM named""",
)
def enrich_left_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = attach_category_names(facts(spark, sf_dir), _lookup(spark, sf_dir))
    return named.select(
        "video_id", "region", "category_id", "category_name", "trending_date_parsed", "views"
    )


@query(
    "enrich_without_lookup",
    f"""WITH {FACTS} SELECT region, category_id, 'Unknown' AS category_name,
      COUNT(*) AS n FROM facts GROUP BY region, category_id""",
)
def enrich_without_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = attach_category_names(facts(spark, sf_dir), None)
    return named.groupBy("region", "category_id", "category_name").agg(
        F.count("*").alias("n")
    )


@query(
    "dedup_lookup",
    """SELECT category_id, category_name FROM (
      SELECT CAST(p_size AS BIGINT) AS category_id, p_name AS category_name,
        row_number() OVER (PARTITION BY p_size ORDER BY p_brand, p_name) AS rn
      FROM part) WHERE rn = 1""",
)
def dedup_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("id"),
        F.col("p_name").alias("snippet.title"),
        F.col("p_brand").alias("region"),
    )
    return category_lookup(reference)
