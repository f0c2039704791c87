"""Rows with structs and JSON text to a table of plain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.flatten import flatten_all
from ..sources import writers


def run_flatten(
    df: DataFrame,
    *,
    path: str | None = None,
    table: str | None = None,
    partition_cols: Sequence[str] = (),
    maps: Sequence[str] = (),
    mode: str = "overwrite",
) -> list[str]:
    """Write ``df`` flattened until nothing nested remains; returns the columns.

    ``maps`` names columns whose keys are data and that are written as JSON text.
    """
    flat = flatten_all(df, maps=maps)
    flat = flat.withColumns({c: flat[f"`{c}`"].cast("string") for c in maps if c in flat.columns})
    if table:
        writers.write_table(flat, table, path=path, partition_cols=partition_cols, mode=mode)
    elif path:
        writers.write_parquet(flat, path, partition_cols=partition_cols, mode=mode)
    else:
        raise ValueError("give a path or a table to write to")
    return flat.columns
