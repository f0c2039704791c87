"""Replacement of a table's partitions that survives a crash.

A run writes its partitions to a folder of its own, ``<table>/runs/<run id>/region=…``, and only then
points the catalog's partitions there, one after the other. So a reader sees every partition either as it
was or as it is going to be, and a run that dies

* while writing has changed nothing: the next one starts from what is stored;
* between two partitions has left a complete folder: the next run of the table finishes it first.

A run that is over is entered in the ledger, ``<table>/ledger/<run id>``. Runs named by what they read,
such as a checkpoint and its batch, are therefore applied once however often they are repeated. Tables
have one writer at a time. Folders that no partition points to any more are removed by
``drop_superseded``, when no reader of an older state is left.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import decode_file_path
from ..session import list_names, path_exists, remove_path, touch
from .writers import add_partitions, evolve_table, partition_spec, spread_by, sql_literal

RUNS, LEDGER, USED, COMPLETE = "runs", "ledger", "used", "_SUCCESS"
#: How a partition without a value is called.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def create_versioned_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_cols: Sequence[str],
    path: str | None = None,
) -> None:
    """An empty table whose partitions the catalog tracks, unless it is there already."""
    if spark.catalog.tableExists(table):
        return
    own = [f for f in schema.fields if f.name not in partition_cols]
    by = [schema[c] for c in partition_cols]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own + by)
    keys = ", ".join(f"`{c}`" for c in partition_cols)
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({keys}){where}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def written_partitions(spark: SparkSession, folder: str, partition_cols: Sequence[str]) -> dict[str, tuple]:
    """Values of the partitions below a folder, by their path in it."""
    paths = [""]
    for c in partition_cols:
        paths = [f"{p}/{name}" for p in paths for name in list_names(spark, folder + p) if name.startswith(f"{c}=")]

    def value(part: str) -> str | None:
        text = unquote(part.split("=", 1)[1])
        return None if text == NULL_PARTITION else text

    return {p[1:]: tuple(value(part) for part in p[1:].split("/")) for p in paths}


def _point(spark: SparkSession, table: str, spec: str, folder: str) -> None:
    """Let a partition that the catalog has be the folder that a run has written."""
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {sql_literal(folder)}")


def _apply(spark: SparkSession, table: str, root: str, run_id: str, partition_cols: Sequence[str]) -> None:
    """Switch the partitions of a complete run, and enter it in the ledger.

    What passes through the driver is a name for each partition, as for any change of the catalog.
    """
    run = f"{root}/{RUNS}/{run_id}"
    written = written_partitions(spark, run, partition_cols)
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    parts = [(path in known, partition_spec(partition_cols, v), f"{run}/{path}") for path, v in written.items()]
    for there, spec, folder in parts:
        if there:
            _point(spark, table, spec, folder)
    add_partitions(spark, table, [(spec, folder) for there, spec, folder in parts if not there])
    spark.catalog.refreshTable(table)
    touch(spark, f"{root}/{LEDGER}/{run_id}")


def finish_runs(spark: SparkSession, table: str, partition_cols: Sequence[str]) -> list[str]:
    """Apply runs that have been written completely but not entered in the ledger."""
    root = location(spark, table)
    done = set(list_names(spark, f"{root}/{LEDGER}"))
    open_runs = [r for r in list_names(spark, f"{root}/{RUNS}") if r not in done]
    complete = [r for r in open_runs if path_exists(spark, f"{root}/{RUNS}/{r}/{COMPLETE}")]
    for run_id in complete:
        _apply(spark, table, root, run_id, partition_cols)
    return complete


def open_runs(spark: SparkSession, table: str, consumer: str) -> list[str]:
    """Applied runs of a table that ``consumer`` has not marked as used, in order of their names."""
    root = location(spark, table)
    used = set(list_names(spark, f"{root}/{USED}/{consumer}"))
    return [r for r in list_names(spark, f"{root}/{LEDGER}") if r not in used]


def mark_used(spark: SparkSession, table: str, consumer: str, runs: Sequence[str]) -> None:
    root = location(spark, table)
    for run_id in runs:
        touch(spark, f"{root}/{USED}/{consumer}/{run_id}")


def partitions_of(spark: SparkSession, table: str, runs: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """The partitions that runs have replaced. A folder that was superseded is named by the later run too."""
    root, schema = location(spark, table), spark.table(table).schema
    found = {v for r in runs for v in written_partitions(spark, f"{root}/{RUNS}/{r}", partition_cols).values()}
    names = T.StructType([T.StructField(c, T.StringType()) for c in partition_cols])
    values = spark.createDataFrame(sorted(found, key=repr), names)
    return values.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols])


def is_applied(spark: SparkSession, table: str, run_id: str) -> bool:
    return path_exists(spark, f"{location(spark, table)}/{LEDGER}/{run_id}")


def replace_partitions(
    spark: SparkSession,
    table: str,
    build: Callable[[], DataFrame],
    schema: T.StructType,
    partition_cols: Sequence[str],
    *,
    run_id: str | None = None,
    path: str | None = None,
    spread: bool = True,
) -> bool:
    """Replace the partitions that ``build()`` brings by its rows; False if the run was applied before.

    ``build`` is called once the table is in order, so it may read the stored rows that it replaces.
    ``spread=False`` is for rows that are dealt out by partition already.
    """
    create_versioned_table(spark, table, schema, partition_cols, path)
    finish_runs(spark, table, partition_cols)
    run_id = run_id or uuid.uuid4().hex
    if is_applied(spark, table, run_id):
        return False
    root, rows = location(spark, table), build()
    evolve_table(spark, table, rows)
    dealt = spread_by(rows, partition_cols) if spread else rows
    writer = dealt.write.mode("overwrite").option("compression", "snappy")
    writer.partitionBy(*partition_cols).parquet(f"{root}/{RUNS}/{run_id}")
    _apply(spark, table, root, run_id, partition_cols)
    return True


def drop_superseded(spark: SparkSession, table: str) -> int:
    """Remove folders of applied runs that no partition points to; returns their number."""
    root, cols = location(spark, table), partition_columns(spark, table)
    folder = decode_file_path(F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))
    used = {_bare(r[0]) for r in spark.table(table).select(folder).distinct().collect()}
    stale = [
        f"{root}/{RUNS}/{r}/{path}"
        for r in list_names(spark, f"{root}/{LEDGER}")
        for path in written_partitions(spark, f"{root}/{RUNS}/{r}", cols)
    ]
    stale = [path for path in stale if _bare(path) not in used]
    for path in stale:
        remove_path(spark, path)
    return len(stale)


def _bare(path: str) -> str:
    """A path without the scheme, in which names of one file can differ."""
    return "/" + path.split(":", 1)[-1].lstrip("/")
