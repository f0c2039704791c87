"""Declared schemas of the Bronze, Silver and quality tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B, _D = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# --- fixed values: column order of the statistics files, as delivered ---------------
BRONZE_STATISTICS_COLUMNS = [
    "video_id", "trending_date", "title", "channel_title", "category_id",
    "publish_time", "tags", "views", "likes", "dislikes", "comment_count",
    "thumbnail_link", "comments_disabled", "ratings_disabled",
    "video_error_or_removed", "description",
]
MEASURES = ["views", "likes", "dislikes", "comment_count"]
FLAGS = ["comments_disabled", "ratings_disabled", "video_error_or_removed"]

BRONZE_STATISTICS = T.StructType(
    [
        T.StructField(
            c,
            T.IntegerType() if c == "category_id" else _L if c in MEASURES else _S,
        )
        for c in BRONZE_STATISTICS_COLUMNS
    ]
)
BRONZE_STATISTICS_TEXT = T.StructType(
    [T.StructField(c, _S) for c in BRONZE_STATISTICS_COLUMNS]
)

REFERENCE_SNIPPET = _struct(channelId=_S, title=_S, assignable=_B)
REFERENCE_ITEM = _struct(kind=_S, etag=_S, id=_S, snippet=REFERENCE_SNIPPET)
# id/snippet at top level serve documents that are a single bare item.
BRONZE_REFERENCE = _struct(
    kind=_S,
    etag=_S,
    items=T.ArrayType(REFERENCE_ITEM),
    id=_S,
    snippet=REFERENCE_SNIPPET,
)

API_ITEM = _struct(
    id=_S,
    snippet=_struct(
        title=_S,
        channelTitle=_S,
        categoryId=_S,
        publishedAt=_S,
        tags=T.ArrayType(_S),
        description=_S,
        thumbnails=_struct(default=_struct(url=_S)),
    ),
    statistics=_struct(viewCount=_S, likeCount=_S, dislikeCount=_S, commentCount=_S),
)
INGEST_METADATA = _struct(
    ingestion_id=_S,
    region=_S,
    ingestion_timestamp=_S,
    video_count=T.IntegerType(),
    source=_S,
)
BRONZE_API = _struct(items=T.ArrayType(API_ITEM), _pipeline_metadata=INGEST_METADATA)

NORMALIZED_COLUMNS = BRONZE_STATISTICS_COLUMNS + ["region"]
SILVER_COLUMNS = NORMALIZED_COLUMNS + [
    "trending_date_parsed", "like_ratio", "engagement_rate", "_processed_at", "_job_name",
]
DEDUP_KEYS = ["video_id", "region", "trending_date_parsed"]

SILVER_REFERENCE_COLUMNS = [
    "category_id", "category_name", "channel_id", "assignable", "kind", "etag", "id",
    "_ingestion_timestamp", "_source_file", "region",
]

DQ_RESULTS = T.StructType(
    [
        T.StructField("check", _S),
        T.StructField("table", _S),
        T.StructField("column", _S),
        T.StructField("value", _D),
        T.StructField("threshold", _D),
        T.StructField("negative_count", _L),
        T.StructField("extreme_count", _L),
        T.StructField("missing_columns", T.ArrayType(_S)),
        T.StructField("latest_record", T.TimestampType()),
        T.StructField("cutoff", T.TimestampType()),
        T.StructField("passed", _B),
        T.StructField("message", _S),
    ]
)
