"""In-line sample records."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

CSV_TEXT = T.StructType(
    [T.StructField(c, T.StringType()) for c in schemas.NORMALIZED_COLUMNS]
)

VIDEO = {
    "video_id": "v1", "trending_date": "17.14.11", "title": "T1", "channel_title": "C1",
    "category_id": "10", "publish_time": "2017-11-13T17:13:01.000Z", "tags": "a|b",
    "views": "1000", "likes": "50", "dislikes": "5", "comment_count": "7",
    "thumbnail_link": "http://x/1.jpg", "comments_disabled": "False",
    "ratings_disabled": "False", "video_error_or_removed": "False",
    "description": "d", "region": "us",
}


def csv_frame(spark, *overrides):
    data = [{**VIDEO, **o} for o in overrides]
    return spark.createDataFrame(
        [tuple(d[c] for c in schemas.NORMALIZED_COLUMNS) for d in data], CSV_TEXT
    )


def api_item(**over):
    v = {**VIDEO, **over}
    item = {
        "id": v["video_id"],
        "snippet": {
            "title": v["title"], "channelTitle": v["channel_title"],
            "categoryId": v["category_id"], "publishedAt": v["publish_time"],
            "tags": v["tags"].split("|"), "description": v["description"],
            "thumbnails": {"default": {"url": v["thumbnail_link"]}},
        },
        "statistics": {
            "viewCount": v["views"], "likeCount": v["likes"],
            "dislikeCount": v["dislikes"], "commentCount": v["comment_count"],
        },
    }
    return item


def write_api_document(base, region, date, hour, items):
    folder = base / f"region={region}" / f"date={date}" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    document = {
        "items": items,
        "_pipeline_metadata": {
            "ingestion_id": "x", "region": region,
            "ingestion_timestamp": f"{date}T{hour}:00:00+00:00",
            "video_count": len(items), "source": "s",
        },
    }
    (folder / "doc.json").write_text(json.dumps(document, indent=1), encoding="utf-8")


def flat_frame(spark, dotted, *overrides):
    """The flattened API shape, with dotted or double-underscore column names."""
    nested = spark.createDataFrame(
        [(api_item(**o),) for o in overrides], T.StructType([T.StructField("i", schemas.API_ITEM)])
    )
    sep = "." if dotted else "__"

    def named(*path):
        return F.col("i." + ".".join(path)).alias(sep.join(path))

    columns = [F.col("i.id").alias("id")]
    columns += [
        named("snippet", f)
        for f in ("title", "channelTitle", "categoryId", "publishedAt", "tags", "description")
    ]
    columns += [named("snippet", "thumbnails", "default", "url")]
    columns += [
        named("statistics", f)
        for f in ("viewCount", "likeCount", "dislikeCount", "commentCount")
    ]
    return nested.select(*columns, F.lit("us").alias("region"), F.lit("2017-11-14").alias("date"))


SILVER = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("channel_title", T.StringType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("trending_date_parsed", T.DateType()),
        T.StructField("views", T.LongType()),
        T.StructField("likes", T.LongType()),
        T.StructField("dislikes", T.LongType()),
        T.StructField("comment_count", T.LongType()),
        T.StructField("like_ratio", T.DoubleType()),
        T.StructField("engagement_rate", T.DoubleType()),
    ]
)


def day(n):
    return dt.date(2020, 1, n)


def silver_frame(spark, *records):
    """(video, channel, category, region, date, views, likes); title T, no dislikes."""
    data = []
    for video, channel, category, region, date, views, likes in records:
        ratio = round(likes / views * 100, 4) if views else 0.0
        data.append(
            (video, "T", channel, category, region, date, views, likes, 0, 0, ratio, ratio)
        )
    return spark.createDataFrame(data, SILVER)
