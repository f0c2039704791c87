"""Query registry, and the statistics view that most queries read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str, *, videos: bool = True) -> DataFrame:
    """Order lines seen as trending records: part = video, supplier = channel.

    ``videos=False`` leaves out the join that brings title and category. The joins carry
    no hints: their inputs grow with the data, so the planner decides from their sizes.
    They are left-deep, so that each dimension is planned by the size of its own files;
    joined with each other first, they would be estimated at the product of their sizes.
    """
    lines, supplier, nation, region, part = (
        table(spark, sf_dir, t)
        for t in ("lineitem", "supplier", "nation", "region", "part")
    )
    df = (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .withColumns({"channel_title": F.col("s_name"), "region": F.lower("r_name")})
    )
    if videos:
        df = df.join(part, df.l_partkey == part.p_partkey)
    title_and_category = (
        [F.col("p_name").alias("title"), F.col("p_size").cast("bigint").alias("category_id"),
         "p_type", "p_brand"]
        if videos
        else []
    )
    return df.select(
        F.col("l_partkey").cast("string").alias("video_id"),
        "channel_title",
        *title_and_category,
        "region",
        F.col("l_shipdate").cast("date").alias("trending_date_parsed"),
        F.floor("l_extendedprice").cast("bigint").alias("views"),
        F.col("l_quantity").cast("bigint").alias("likes"),
        F.rint(F.col("l_discount") * 100).cast("bigint").alias("dislikes"),
        F.rint(F.col("l_tax") * 100).cast("bigint").alias("comment_count"),
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    ).withColumns(
        {
            "like_ratio": metrics.like_ratio(F.col("likes"), F.col("views")),
            "engagement_rate": metrics.engagement_rate(
                F.col("likes"), F.col("dislikes"), F.col("comment_count"), F.col("views")
            ),
        }
    )


FACTS = """
base AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id, p_name AS title, s_name AS channel_title,
         CAST(p_size AS BIGINT) AS category_id, p_type, p_brand, lower(r_name) AS region,
         CAST(l_shipdate AS DATE) AS trending_date_parsed,
         CAST(floor(l_extendedprice) AS BIGINT) AS views,
         CAST(l_quantity AS BIGINT) AS likes,
         CAST(round(l_discount * 100) AS BIGINT) AS dislikes,
         CAST(round(l_tax * 100) AS BIGINT) AS comment_count,
         l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
),
facts AS (
  SELECT *,
    CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0.0 END AS like_ratio,
    CASE WHEN views > 0
         THEN round((likes + dislikes + comment_count) / views * 100, 4)
         ELSE 0.0 END AS engagement_rate
  FROM base
)
"""

NAMED = (
    FACTS
    + """,
named AS (
  SELECT facts.*, coalesce(n_name, 'Unknown') AS category_name
  FROM facts LEFT JOIN nation ON category_id = n_nationkey
)
"""
)


def category_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations seen as a category reference table; ids above 24 stay unmatched."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("snippet_title"),
    )


def mean_sql(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(28,4))) AS DOUBLE) / COUNT({column})"
