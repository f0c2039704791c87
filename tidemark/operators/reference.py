"""Category reference documents to Silver reference rows."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import casts, dates
from ..schemas import SILVER_REFERENCE_COLUMNS
from ..sources.files import CORRUPT
from .dedup import dedup_keep_last, keep_first
from .normalize import explode_items

log = logging.getLogger(__name__)

REQUIRED_COLUMNS = {"id", "snippet.title"}


@dataclass(frozen=True)
class ReferenceLoad:
    """Rows to store, one processed row per good file, one error row per bad file."""

    rows: DataFrame
    processed: DataFrame
    errors: DataFrame


def missing_columns(columns: Sequence[str], required: set[str] = REQUIRED_COLUMNS) -> set[str]:
    """Required names that are absent; only warned about, as shapes vary by version."""
    absent = required - set(columns)
    if absent:
        log.warning("missing expected columns: %s", sorted(absent))
    return absent


def _error() -> Column:
    bare = F.col("items").isNull() & F.col("id").isNull() & F.col("snippet").isNull()
    empty = F.lit("no category items found")
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed JSON document"))
        .when(F.array_size("items") == 0, empty)
        .when(bare, empty)
    )


def load_reference(
    documents: DataFrame,
    *,
    document_keys: Sequence[str] = ("_source_file",),
    newest_per_region: bool = True,
    as_of: Column | None = None,
) -> ReferenceLoad:
    """Flatten documents read by ``files.read_reference_json``.

    A bad document becomes an error row and does not stop the others. Within a document
    the last item of an id wins; the document is what ``document_keys`` identify. A
    document without ``items`` is taken as a single item itself. Of several good files
    for a region the newest stands, as if they had been loaded one after the other, each
    replacing its region.
    """
    judged = documents.withColumn("_error", _error())
    good = judged.filter(F.col("_error").isNull())
    if newest_per_region:
        newest = [F.col("_modified").desc(), F.col("_source_file").desc()]
        good = keep_first(good, ["region"], newest)
    whole = F.struct("kind", "etag", "id", "snippet")
    extra = [c for c in document_keys if c not in ("_source_file", "region")]
    items = explode_items(
        good.select(
            "_source_file", "region", "items", "kind", "etag", "id", "snippet",
            *[F.col(c).alias(f"_key_{c}") for c in extra],
        ),
        whole=whole,
    )
    now = F.current_timestamp() if as_of is None else as_of
    flat = items.select(
        casts.to_long(F.col("item.id")).alias("category_id"),
        F.col("item.snippet.title").alias("category_name"),
        F.col("item.snippet.channelId").alias("channel_id"),
        F.col("item.snippet.assignable").alias("assignable"),
        F.col("item.kind").alias("kind"),
        F.col("item.etag").alias("etag"),
        F.col("item.id").alias("id"),
        dates.iso_stamp(now).alias("_ingestion_timestamp"),
        "_source_file",
        "region",
        "position",
        *[f"_key_{c}" for c in extra],
    )
    keys = [f"_key_{c}" if c in extra else c for c in document_keys]
    rows = dedup_keep_last(flat, [*keys, "id"]).select(*SILVER_REFERENCE_COLUMNS)
    processed = rows.groupBy("_source_file", "region").agg(F.count("*").alias("rows"))
    errors = judged.filter(F.col("_error").isNotNull()).select(
        "_source_file", F.col("_error").alias("error")
    )
    return ReferenceLoad(rows, processed, errors)
