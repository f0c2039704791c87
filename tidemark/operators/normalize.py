"""Unify the delivered shapes of trending records into one set of columns.

Shapes are told apart by column names, which is a decision made while the plan is built
and costs no job:

* ``csv``    - the sixteen delivered columns, text or typed
* ``flat``   - flattened API columns, named ``snippet.title`` or ``snippet__title``
* ``nested`` - API documents with an ``items`` array, or ``snippet`` structs
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import casts, dates

INGEST_ORDER = "_ingest_order"

# --- fixed values: where each Silver column sits in an API record --------------------
API_PATHS = {
    "video_id": "id",
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "tags": "snippet.tags",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount",
    "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description",
}
API_OPTIONAL = {"tags", "dislikes", "thumbnail_link"}


def detect_shape(df: DataFrame) -> str:
    names = set(df.columns)
    if "items" in names or isinstance(_type_at(df.schema, ["snippet"]), T.StructType):
        return "nested"
    if names & {"snippet.title", "snippet__title"}:
        return "flat"
    return "csv"


def explode_items(
    df: DataFrame, items: str = "items", whole: Column | None = None
) -> DataFrame:
    """One row per array element, as column ``item`` with its ``position``.

    Documents without the array yield one row holding ``whole`` (or are dropped when no
    fallback is given); an empty array yields none.
    """
    source = F.col(items)
    if whole is not None:
        source = F.coalesce(source, F.array(whole))
    kept = [c for c in df.columns if c != items]
    return df.select(*kept, F.posexplode(source).alias("position", "item"))


def _type_at(schema: T.StructType, path: list[str]) -> T.DataType | None:
    here: T.DataType = schema
    for name in path:
        if not isinstance(here, T.StructType) or name not in here.fieldNames():
            return None
        here = here[name].dataType
    return here


def _locate(df: DataFrame, path: str) -> tuple[Column, T.DataType] | None:
    """The column for ``a.b``: a nested field, a dotted name, or ``a__b``."""
    parts = path.split(".")
    dtype = _type_at(df.schema, parts)
    if dtype is not None:
        return F.col(".".join(f"`{p}`" for p in parts)), dtype
    for name in (path, path.replace(".", "__")):
        if name in df.columns:
            return F.col(f"`{name}`"), df.schema[name].dataType
    return None


def _as_text(c: Column, dtype: T.DataType) -> Column:
    return F.array_join(c, "|") if isinstance(dtype, T.ArrayType) else c.cast("string")


def _ingest_order(df: DataFrame) -> Column:
    """Text that sorts by ingestion time, for choosing the latest of several records."""
    names = set(df.columns)
    if "_pipeline_metadata" in names:
        return F.col("_pipeline_metadata.ingestion_timestamp")
    if {"date", "hour"} <= names:
        return F.concat_ws("T", F.col("date").cast("string"), F.col("hour").cast("string"))
    if "_ingestion_timestamp" in names:
        return F.col("_ingestion_timestamp").cast("string")
    return F.lit(None).cast("string")


def _from_api(df: DataFrame, as_of: Column) -> DataFrame:
    chosen: dict[str, Column] = {}
    for name, path in API_PATHS.items():
        found = _locate(df, path)
        numeric = name in schemas.MEASURES or name == "category_id"
        if found is None:
            if name not in API_OPTIONAL:
                raise ValueError(f"API records lack '{path}'")
            chosen[name] = (
                F.lit(0).cast("bigint") if numeric else F.lit(None).cast("string")
            )
        else:
            chosen[name] = casts.to_long(*found) if numeric else _as_text(*found)
    day = F.col("date").try_cast("date") if "date" in df.columns else F.lit(None)
    chosen["trending_date"] = dates.trending_stamp(F.coalesce(day, as_of.cast("date")))
    for flag in schemas.FLAGS:
        chosen[flag] = F.lit(False)
    return _ordered(df, chosen)


def _from_csv(df: DataFrame) -> DataFrame:
    chosen: dict[str, Column] = {}
    for name in schemas.BRONZE_STATISTICS_COLUMNS:
        column, dtype = F.col(name), df.schema[name].dataType
        if name in schemas.MEASURES or name == "category_id":
            chosen[name] = casts.to_long(column, dtype)
        elif name in schemas.FLAGS:
            chosen[name] = casts.to_flag(column, dtype)
        else:
            chosen[name] = column.cast("string")
    return _ordered(df, chosen)


def _ordered(df: DataFrame, chosen: dict[str, Column]) -> DataFrame:
    columns = [chosen[c].alias(c) for c in schemas.BRONZE_STATISTICS_COLUMNS]
    return df.select(
        *columns,
        F.col("region").cast("string").alias("region"),
        _ingest_order(df).alias(INGEST_ORDER),
    )


def normalize(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Typed common columns plus ``_ingest_order``, whichever shape ``df`` has.

    API records take their trending date from the ``date`` partition, else from
    ``as_of`` (default: today).
    """
    shape = detect_shape(df)
    if shape == "csv":
        return _from_csv(df)
    if shape == "nested" and "items" in df.columns:
        exploded = explode_items(df)
        df = exploded.select(
            *[c for c in exploded.columns if c not in ("position", "item")], "item.*"
        )
    return _from_api(df, F.current_date() if as_of is None else as_of)


def unify(*frames: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One table out of inputs of any shape."""
    first, *rest = [normalize(f, as_of) for f in frames]
    for other in rest:
        first = first.unionByName(other)
    return first
