"""Row-level cleansing of statistics, and the repair of raw delivered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts, dates, metrics, text
from ..schemas import BRONZE_STATISTICS_COLUMNS, FLAGS, MEASURES
from ..sources.files import is_overlong


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def cleanse(df: DataFrame) -> DataFrame:
    """Drop rows without a video, normalise regions, parse dates, fill measures with 0."""
    return drop_null_keys(df, "video_id").withColumns(
        {
            "region": text.normalize_region(F.col("region")),
            "trending_date_parsed": dates.parse_trending_date(F.col("trending_date")),
            **{m: casts.zero_if_null(F.col(m)) for m in MEASURES},
        }
    )


def derive(df: DataFrame) -> DataFrame:
    views, likes = F.col("views"), F.col("likes")
    return df.withColumns(
        {
            "like_ratio": metrics.like_ratio(likes, views),
            "engagement_rate": metrics.engagement_rate(
                likes, F.col("dislikes"), F.col("comment_count"), views
            ),
        }
    )


def stamp_run(df: DataFrame, job_name: str, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return df.withColumns({"_processed_at": now, "_job_name": F.lit(job_name)})


def tidy_strings(df: DataFrame) -> DataFrame:
    """No line breaks inside, no white space around, in any text column."""
    return df.withColumns(
        {
            f.name: text.tidy_text(F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
        }
    )


_OVERLONG, _CATEGORY = "_overlong", "_category_number"


def flag_repairs(raw: DataFrame) -> DataFrame:
    """Tidied rows of ``files.read_text_csv``, flagged with what is wrong with them."""
    n = len(BRONZE_STATISTICS_COLUMNS)
    kept = raw.select(
        *BRONZE_STATISTICS_COLUMNS, "region", is_overlong(n).alias(_OVERLONG)
    )
    return tidy_strings(kept).withColumns(
        {
            **{c: F.lower(c) for c in FLAGS},
            # An id beyond the range of a whole number is no id: dropped and counted like text.
            _CATEGORY: casts.to_number(F.col("category_id")).try_cast("bigint"),
        }
    )


def repaired(flagged: DataFrame) -> DataFrame:
    """The usable ones of flagged rows: well-formed, with a numeric category id."""
    return (
        flagged.filter(~F.col(_OVERLONG) & F.col(_CATEGORY).isNotNull())
        .withColumn("category_id", F.col(_CATEGORY))
        .drop(_OVERLONG, _CATEGORY)
    )


def repair(raw: DataFrame) -> DataFrame:
    return repaired(flag_repairs(raw))


def repair_counts(flagged: DataFrame) -> DataFrame:
    """Per region: rows read, malformed lines skipped, rows dropped, rows kept.

    Malformed lines do not count as rows read.
    """
    bad = F.col(_OVERLONG)
    numeric = F.col(_CATEGORY).isNotNull()
    return flagged.groupBy("region").agg(
        F.count_if(~bad).alias("rows_before"),
        F.count_if(bad).alias("lines_skipped"),
        F.count_if(~bad & ~numeric).alias("rows_dropped"),
        F.count_if(~bad & numeric).alias("rows_after"),
    )
