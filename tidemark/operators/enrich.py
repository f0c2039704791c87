"""Category names for statistics."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts

log = logging.getLogger(__name__)

UNKNOWN = "Unknown"


def category_lookup(reference: DataFrame) -> DataFrame | None:
    """(category_id, category_name), unique by id, from any of the known layouts.

    Several names for one id are settled by the lowest (region, name), so that reruns
    agree; grouping by id is also what guarantees that the join below adds no rows.
    None when no layout fits.
    """
    names = set(reference.columns)
    if {"category_id", "category_name"} <= names:
        key, name = F.col("category_id"), F.col("category_name")
    elif {"id", "snippet.title"} <= names:
        key, name = F.col("id"), F.col("`snippet.title`")
    elif {"id", "snippet_title"} <= names:
        key, name = F.col("id"), F.col("snippet_title")
    else:
        log.warning("no category title among the columns %s", reference.columns)
        return None
    region = F.col("region").cast("string") if "region" in names else F.lit("")
    dtype = reference.select(key.alias("k")).schema["k"].dataType
    return (
        reference.select(
            casts.to_long(key, dtype).alias("category_id"),
            F.struct(
                F.coalesce(region, F.lit("")).alias("region"), name.alias("category_name")
            ).alias("pick"),
        )
        .filter(F.col("category_id").isNotNull() & F.col("pick.category_name").isNotNull())
        .groupBy("category_id")
        .agg(F.min("pick").alias("pick"))
        .select("category_id", F.col("pick.category_name").alias("category_name"))
    )


def attach_category_names(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Left join on ``category_id``; ``category_name`` always exists and is never NULL.

    Ids without a match, and all ids when there is no lookup, are named ``Unknown``.
    The lookup must be unique by id, as ``category_lookup`` makes it. The join carries no hint:
    the planner broadcasts a lookup whose size it has found to be small, and otherwise shuffles
    and splits the tasks of frequent categories.
    """
    if lookup is None:
        return stats.withColumn("category_name", F.lit(UNKNOWN))
    stats = stats.drop("category_name").withColumn(
        "category_id", F.col("category_id").cast("bigint")
    )
    return stats.join(lookup, "category_id", "left").fillna(UNKNOWN, subset=["category_name"])
