"""De-duplication operators. All of them have one deterministic outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DEDUP_KEYS

_ROW = "_row_num"


def keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """The first row per key.

    Spark plans the rank filter as a group limit that runs before the shuffle as well as
    after it, so each task sends on at most one row per key and a key that holds a large
    part of the table does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn(_ROW, F.row_number().over(window))
        .filter(F.col(_ROW) == 1)
        .drop(_ROW)
    )


#: Columns that say when and by which run a row was made, not what it holds.
RUN_STAMPS = ("_processed_at", "_job_name")


def content_order(df: DataFrame) -> list[Column]:
    """An order by what rows hold: a hash first, then the columns, so a collision cannot decide."""
    held = [f for f in df.schema.fields if f.name not in RUN_STAMPS]
    plain = [f for f in held if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    columns = [F.col(f"`{f.name}`") for f in plain]
    rest = [F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in held if f not in plain]
    return [F.xxhash64(*columns, *rest), *columns, *rest]


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = tuple(DEDUP_KEYS),
    latest: Sequence[str] = ("_processed_at",),
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """The latest row per key.

    All rows of one run share a processing time, so ties are settled by ``tie_break``, by
    default by the content of the rows without the stamps of the run, so that another run
    over the same rows keeps the same ones.
    """
    ties = content_order(df) if tie_break is None else list(tie_break)
    present = [F.col(c).desc_nulls_last() for c in latest if c in df.columns]
    return keep_first(df, keys, [*present, *ties])


def dedup_keep_last(
    df: DataFrame, keys: Sequence[str], position: str = "position"
) -> DataFrame:
    """The row with the highest position per key, e.g. the last item of a document."""
    return keep_first(df, keys, [F.col(position).desc()])
