"""The three Gold marts.

Each mart is built in two steps: a hash aggregate down to a fine grain with map-side
combine, then the mart itself from that grain. The fine grain splits a region, channel or
day that holds a large part of the table over many tasks, distinct counts expand grain
rows instead of raw rows, and category names are joined to grain rows only.
Averages are exact sums divided by counts, so partial aggregation does not change them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..session import stage
from .enrich import attach_category_names
from .ranking import rank_within, top_within

DAILY_GRAIN = ["region", "trending_date_parsed", "channel_title", "category_id"]
#: Measures of the grain that are added up; ``max_views`` is a bound.
DAILY_SUMS = ["n_videos", "views", "n_views", "likes", "comments", "engagement", "n_engagement", "dislikes", "like_ratio", "n_like_ratio"]
VIDEO_GRAIN = ["channel_title", "region", "video_id", "category_id"]
NO_LOOKUP = object()


def _measures() -> list[Column]:
    return [
        F.count("video_id").alias("n_videos"),
        F.sum("views").alias("views"),
        F.count("views").alias("n_views"),
        F.sum("likes").alias("likes"),
        F.sum("comment_count").alias("comments"),
        F.max("views").alias("max_views"),
        F.sum(metrics.ratio_units(F.col("engagement_rate"))).alias("engagement"),
        F.count("engagement_rate").alias("n_engagement"),
    ]


def _total(name: str) -> Column:
    return F.sum(name)


def _mean(total: str, n: str) -> Column:
    return metrics.average(F.sum(total), F.sum(n))


def _mean_ratio(units: str, n: str) -> Column:
    return metrics.average_ratio(F.sum(units), F.sum(n))


def _named(grain: DataFrame, lookup: DataFrame | None | object) -> DataFrame:
    """Grain rows with category names: from the input itself, or from the lookup."""
    if lookup is NO_LOOKUP:
        return grain
    return attach_category_names(grain, lookup)


def _keys(stats: DataFrame, keys: list[str], lookup: DataFrame | None | object) -> list[str]:
    if lookup is NO_LOOKUP and "category_name" not in stats.columns:
        raise ValueError("pass a lookup, or statistics that have category_name")
    return keys + ["category_name"] if lookup is NO_LOOKUP else keys


def daily_grain(stats: DataFrame, *extra_keys: str) -> DataFrame:
    """Measures per region, day, channel and category; feeds two of the marts."""
    return stats.groupBy(*DAILY_GRAIN, *extra_keys).agg(
        *_measures(),
        F.sum("dislikes").alias("dislikes"),
        F.sum(metrics.ratio_units(F.col("like_ratio"))).alias("like_ratio"),
        F.count("like_ratio").alias("n_like_ratio"),
        F.count("trending_date_parsed").alias("n_days"),
    )


def trending_from_grain(grain: DataFrame) -> DataFrame:
    return grain.groupBy("region", "trending_date_parsed").agg(
        *_trending_measures(),
        F.count_distinct("channel_title").alias("unique_channels"),
        F.count_distinct("category_id").alias("unique_categories"),
    )


def _trending_measures() -> list[Column]:
    return [
        _total("n_videos").alias("total_videos"),
        _total("views").alias("total_views"),
        _total("likes").alias("total_likes"),
        _total("dislikes").alias("total_dislikes"),
        _total("comments").alias("total_comments"),
        _mean("views", "n_views").alias("avg_views_per_video"),
        _mean_ratio("like_ratio", "n_like_ratio").alias("avg_like_ratio"),
        _mean_ratio("engagement", "n_engagement").alias("avg_engagement_rate"),
        F.max("max_views").alias("max_views"),
    ]


def category_from_grain(grain: DataFrame, day_totals: DataFrame | None = None) -> DataFrame:
    """Daily category totals; grain rows must carry ``category_name``."""
    mart = grain.groupBy(
        "category_name", "category_id", "region", "trending_date_parsed"
    ).agg(
        _total("n_videos").alias("video_count"),
        _total("views").alias("total_views"),
        _total("likes").alias("total_likes"),
        _total("comments").alias("total_comments"),
        _mean_ratio("engagement", "n_engagement").alias("avg_engagement_rate"),
        F.count_distinct("channel_title").alias("unique_channels"),
    )
    return with_view_share(mart, daily_views(grain) if day_totals is None else day_totals)


def category_days(grain: DataFrame) -> DataFrame:
    """The grain without channels: measures per region, day and category; feeds both daily marts.

    Grain rows are one per their keys, so a channel comes once in each of these groups and is counted as it comes.
    """
    return grain.groupBy("region", "trending_date_parsed", "category_id").agg(
        *[_total(c).alias(c) for c in DAILY_SUMS],
        F.max("max_views").alias("max_views"),
        F.count("channel_title").alias("channels"),
    )


def daily_channels(grain: DataFrame) -> DataFrame:
    """Distinct channels per region and day, where a channel can have several categories."""
    once = grain.select("region", "trending_date_parsed", "channel_title").distinct()
    return once.groupBy(F.col("region").alias("_region"), F.col("trending_date_parsed").alias("_day")).agg(
        F.count("channel_title").alias("unique_channels")
    )


def trending_from_categories(by_category: DataFrame, channels: DataFrame) -> DataFrame:
    """Daily totals from rows of ``category_days`` and ``daily_channels``."""
    totals = by_category.groupBy("region", "trending_date_parsed").agg(
        *_trending_measures(), F.count("category_id").alias("unique_categories")
    )
    names = [c for c in totals.columns if c != "unique_categories"]
    return totals.join(channels, _same_day()).select(*names, "unique_channels", "unique_categories")


def category_from_categories(by_category: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Daily category totals from rows of ``category_days``, whose ids must be whole numbers.

    Other ids can become equal when they are matched with the lookup's; these take ``category_from_grain``.
    """
    mart = attach_category_names(by_category, lookup).select(
        "category_name",
        "category_id",
        "region",
        "trending_date_parsed",
        F.col("n_videos").alias("video_count"),
        F.col("views").alias("total_views"),
        F.col("likes").alias("total_likes"),
        F.col("comments").alias("total_comments"),
        metrics.average_ratio(F.col("engagement"), F.col("n_engagement")).alias("avg_engagement_rate"),
        F.col("channels").alias("unique_channels"),
    )
    return with_view_share(mart, daily_views(by_category))


def _same_day() -> Column:
    """Rows without a region or a date are of one day too."""
    return F.col("region").eqNullSafe(F.col("_region")) & F.col("trending_date_parsed").eqNullSafe(F.col("_day"))


def daily_views(rows: DataFrame) -> DataFrame:
    """Views per region and day; reads three columns of statistics or of the grain."""
    return rows.groupBy(
        F.col("region").alias("_region"), F.col("trending_date_parsed").alias("_day")
    ).agg(F.sum("views").alias("_day_views"))


def with_view_share(mart: DataFrame, day_totals: DataFrame) -> DataFrame:
    """Share of a category in the views of its region and day; NULL for no views at all.

    Totals are joined rather than taken over a window, which would hold all rows of a
    region and day in one task. Rows without a region or a date meet their totals too.
    """
    share = metrics.percent(F.col("total_views"), F.col("_day_views"), 2)
    return mart.join(day_totals, _same_day()).select(
        *mart.columns, share.alias("view_share_pct")
    )


def channel_totals(
    stats: DataFrame, lookup: DataFrame | None | object = NO_LOOKUP
) -> DataFrame:
    """Channel mart without ranks."""
    grain = stats.groupBy(*_keys(stats, VIDEO_GRAIN, lookup)).agg(
        *_measures(),
        F.count("trending_date_parsed").alias("n_days"),
        F.min("trending_date_parsed").alias("first_day"),
        F.max("trending_date_parsed").alias("last_day"),
    )
    return _named(grain, lookup).groupBy("channel_title", "region").agg(
        F.count_distinct("video_id").alias("total_videos"), *_channel_measures("first_day", "last_day")
    )


def _channel_measures(first_day: str, last_day: str) -> list[Column]:
    return [
        _total("views").alias("total_views"),
        _total("likes").alias("total_likes"),
        _total("comments").alias("total_comments"),
        _mean("views", "n_views").alias("avg_views_per_video"),
        _mean_ratio("engagement", "n_engagement").alias("avg_engagement_rate"),
        F.max("max_views").alias("peak_views"),
        _total("n_days").alias("times_trending"),
        F.min(first_day).alias("first_trending"),
        F.max(last_day).alias("last_trending"),
        F.array_sort(F.collect_set("category_name")).alias("categories"),
    ]


def channel_categories(grain: DataFrame) -> DataFrame:
    """The grain without days: measures per channel, region and category, few enough to collect sets from."""
    day = "trending_date_parsed"
    return grain.groupBy("channel_title", "region", "category_id").agg(
        *[_total(c).alias(c) for c in ("views", "n_views", "likes", "comments", "engagement", "n_engagement", "n_days")],
        F.max("max_views").alias("max_views"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def channel_from_categories(by_category: DataFrame, video_counts: DataFrame) -> DataFrame:
    """Channel mart without ranks, from rows of ``channel_categories`` with ``category_name`` and counts of distinct videos."""
    totals = by_category.groupBy("channel_title", "region").agg(*_channel_measures("first_day", "last_day"))
    counts = video_counts.select(F.col("channel_title").alias("_c"), F.col("region").alias("_r"), "total_videos")
    same = F.col("channel_title").eqNullSafe(F.col("_c")) & F.col("region").eqNullSafe(F.col("_r"))
    measures = [c for c in totals.columns if c not in ("channel_title", "region")]
    return totals.join(counts, same).select("channel_title", "region", "total_videos", *measures)


def _video_hash(region: str, video: str) -> Column:
    """Goes first among the keys of a join by video: a sort by a number rarely has to look at the texts behind it."""
    return F.xxhash64(region, video)


def new_videos(stats: DataFrame, known: DataFrame | None) -> DataFrame:
    """(region, video_id, number) for videos that have no number yet, from the region's highest number on.

    Numbers go by channel, so that videos of a channel that arrive together lie close to each other. Which channel
    comes first does not matter; hashes of them are aggregated without sorting.
    """
    found = stats.groupBy("region", "video_id").agg(F.min(F.xxhash64("channel_title")).alias("_channel"))
    highest = F.lit(0)
    if known is not None:
        own = known.select(F.col("region").alias("_r"), F.col("video_id").alias("_v"), "number")
        same_region = F.col("region").eqNullSafe(F.col("_r"))
        same_hash = _video_hash("region", "video_id") == _video_hash("_r", "_v")
        found = found.join(own, same_hash & same_region & (F.col("video_id") == F.col("_v")), "left_anti")
        # Mostly few, and ranking looks at them twice.
        found = stage(found, "new-videos")
        tops = own.groupBy("_r").agg(F.max("number").alias("_top"))
    ranked = rank_within(found, ["region"], [F.col("_channel").asc(), F.col("video_id").asc()], "number")
    if known is not None:
        ranked = ranked.join(tops, same_region, "left")
        highest = F.coalesce("_top", F.lit(0))
    return ranked.select("region", "video_id", (F.col("number") + highest).alias("number"))


def video_bitmaps(
    stats: DataFrame, numbers: DataFrame, keys: list[str], *, dealt: Callable[[DataFrame, list[str]], DataFrame] | None = None
) -> DataFrame:
    """Which videos a channel has, per ``keys``, as bitmaps over their numbers, 64 numbers each.

    A bitmap is one long, so there are at most as many of them as distinct videos of channels, however far
    apart the numbers of a channel lie, and they are merged in a hash aggregate. ``dealt`` brings the rows of
    ``keys`` to where they are written, without parting those of one bitmap; columns that it adds are dropped.
    """
    own = numbers.select(F.col("region").alias("_r"), F.col("video_id").alias("_v"), "number")
    same = (
        (_video_hash("region", "video_id") == _video_hash("_r", "_v"))
        & F.col("region").eqNullSafe(F.col("_r"))
        & (F.col("video_id") == F.col("_v"))
    )
    by = list(dict.fromkeys([*keys, "region", "channel_title"]))
    rows = stats.select(*dict.fromkeys([*by, "video_id"])).join(own, same).select(
        *by,
        F.shiftright("number", 6).alias("bucket"),
        F.expr("shiftleft(1L, CAST(number & 63 AS INT))").alias("bit"),
    )
    found = [*by, "bucket"]
    if dealt is not None:
        rows = dealt(rows, ["channel_title", "bucket"])
    # What else is in the rows is where they have been dealt to.
    return rows.groupBy(*found, *[c for c in rows.columns if c not in (*found, "bit")]).agg(
        F.bit_or("bit").alias("videos")
    ).select(*found, "videos")


def distinct_videos(bitmaps: DataFrame) -> DataFrame:
    """Exact numbers of distinct videos per channel, whatever days and parts their bitmaps are from."""
    merged = bitmaps.groupBy("channel_title", "region", "bucket").agg(F.bit_or("videos").alias("videos"))
    counted = merged.groupBy("channel_title", "region").agg(F.sum(F.bit_count("videos")).alias("total_videos"))
    return counted.select("channel_title", "region", F.col("total_videos").cast("bigint"))


def ranked_channels(totals: DataFrame) -> DataFrame:
    """Channel totals with the channel's rank by views in its region."""
    order = [F.col("total_views").desc(), F.col("channel_title").asc()]
    return rank_within(totals, ["region"], order, "rank_in_region")


def trending_analytics(stats: DataFrame) -> DataFrame:
    """Daily totals per region."""
    return trending_from_grain(daily_grain(stats))


def channel_analytics(
    stats: DataFrame, lookup: DataFrame | None | object = NO_LOOKUP
) -> DataFrame:
    """Channel performance with the channel's rank by views in its region.

    Without ``lookup`` the input must have ``category_name``; ``lookup=None`` means the
    lookup is missing, and every category is unknown.
    """
    return ranked_channels(channel_totals(stats, lookup))


def top_channels_by_region(totals: DataFrame, k: int) -> DataFrame:
    """The ``k`` most viewed channels of each region."""
    order = [F.col("total_views").desc(), F.col("channel_title").asc()]
    return top_within(totals, ["region"], order, k, "rank_in_region")


def category_analytics(
    stats: DataFrame, lookup: DataFrame | None | object = NO_LOOKUP
) -> DataFrame:
    """Daily category totals per region with the category's share of views."""
    extra = _keys(stats, [], lookup)
    # Read twice below, for the mart and for the totals of each day.
    grain = stage(daily_grain(stats, *extra), "grain")
    return category_from_grain(_named(grain, lookup), daily_views(grain))


def stamp_aggregation(mart: DataFrame, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return mart.withColumn("_aggregated_at", now)
