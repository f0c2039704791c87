"""Session settings and the shared scratch space that staged results live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # collect_set runs in an object hash aggregate; the default of 128 keys per task
    # sends every realistic channel count into its sort-based path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # The JVM does not compile methods above 8000 bytes of bytecode; fused stages beyond
    # that would run interpreted, so let Spark split them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session carrying the settings the library is tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder all executors share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where it names none, a
    machine-local folder is used in local mode only, where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = f"{tempfile.gettempdir()}/tidemark-scratch"
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A scratch path that is removed when the application ends, if not before."""
    path = scratch_path(spark, label)
    fs, target = _located(spark, path)
    fs.deleteOnExit(target)
    return path


#: What the innermost ``staging`` block of this thread or task has staged.
_open_stage: ContextVar[list[str] | None] = ContextVar("open_stage", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, what was staged in it by the same thread."""
    paths: list[str] = []
    token = _open_stage.set(paths)
    try:
        yield
    finally:
        _open_stage.reset(token)
        for path in paths:
            remove_path(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return a scan of what was written.

    Cuts lineage in a form that outlives lost executors, and unlike an RDD checkpoint
    keeps column pruning, push-down and size statistics for the readers of the result.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    paths = _open_stage.get()
    if paths is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A task of a shuffle takes about this many rows, which it sorts and groups in memory.
TASK_ROWS = 500_000


@contextmanager
def sized_shuffles(spark: SparkSession) -> Iterator[Callable[[int], None]]:
    """Within the block, a call with a number of rows gives shuffles as many partitions as these rows need.

    There are never fewer than the session has set, which comes back at the end of the block; the adaptive
    planner puts small ones together.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)

    def size(rows: int) -> None:
        spark.conf.set(key, max(int(before), -(-rows // TASK_ROWS)))

    try:
        yield size
    finally:
        spark.conf.set(key, before)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    fs, target = _located(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path the library itself has written."""
    fs, target = _located(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, target = _located(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, target = _located(spark, path)
    fs.create(target, True).close()


def rename(spark: SparkSession, path: str, new: str) -> None:
    fs, target = _located(spark, path)
    fs.rename(target, _located(spark, new)[1])
