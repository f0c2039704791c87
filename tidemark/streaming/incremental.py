"""Load only what has arrived since the last successful run.

The checkpoint of an available-now file stream records which files were taken, so a run
reads each new file once and ends; a run without new files does nothing. Each batch is
merged with the stored partitions it touches, which makes replays idempotent and keeps no
de-duplication state between runs. A catalog table takes each batch as a run of
``sources.versions``, named by checkpoint and batch, so a replayed batch is applied once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import content_order, dedup_latest
from ..operators.reference import load_reference
from ..schemas import DEDUP_KEYS
from ..session import path_exists, remove_path, sized_shuffles, stage, staging
from ..functions.text import decode_file_path
from ..sources import files, manifest, versions, writers

def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType,
    *,
    options: dict[str, str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path``; schemas are declared, never inferred, for a stream."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def touched_values(batch: DataFrame, partition_cols: Sequence[str]) -> Column:
    """A literal predicate per partition column on the values in a batch, which prunes directories.

    It may let in more than the partitions touched: all combinations of their values. What comes
    to the driver are values of single partition columns, no more of them than directories that
    the batch is about to be written to.
    """
    found = batch.agg(
        *[F.collect_set(c).alias(f"values_{i}") for i, c in enumerate(partition_cols)],
        *[F.bool_or(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(partition_cols)],
    ).first()
    predicate = F.lit(True)
    for i, c in enumerate(partition_cols):
        listed = F.col(c).isin(found[f"values_{i}"])
        predicate = predicate & (listed | F.col(c).isNull() if found[f"null_{i}"] else listed)
    return predicate


def stored_rows(
    batch: DataFrame, path: str, partition_cols: Sequence[str]
) -> DataFrame | None:
    """Stored rows of exactly the partitions the batch touches; None before any load."""
    spark = batch.sparkSession
    if not path_exists(spark, path):
        return None
    return in_touched_partitions(spark.read.schema(batch.schema).parquet(path), batch, partition_cols)


def in_touched_partitions(stored: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``stored`` in exactly the partitions of ``batch``; prunes directories first."""
    near = stored.filter(touched_values(batch, partition_cols))
    touched = batch.select(*[F.col(c).alias(f"_t_{c}") for c in partition_cols]).distinct()
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in partition_cols],
    )
    return near.join(touched, same, "left_semi")


def merge_batch(
    batch: DataFrame,
    path: str,
    stage_path: str,
    *,
    partition_cols: Sequence[str],
    keys: Sequence[str],
    latest: Sequence[str],
    tie_break: Sequence[Column] | None = None,
) -> None:
    """Replace the touched partitions by (stored rows and batch), de-duplicated.

    The merged rows are completed at ``stage_path`` before any stored partition is
    touched. A run that died while replacing partitions finds them there and replaces
    again from them, rather than merging with half-replaced partitions.
    """
    spark = batch.sparkSession
    if not path_exists(spark, f"{stage_path}/_SUCCESS"):
        if batch.isEmpty():
            return
        stored = stored_rows(batch, path, partition_cols)
        both = batch if stored is None else stored.unionByName(batch)
        merged = dedup_latest(both, keys, latest=latest, tie_break=tie_break)
        merged.write.mode("overwrite").parquet(stage_path)
    merged = spark.read.schema(batch.schema).parquet(stage_path)
    writers.write_parquet(merged, path, partition_cols=partition_cols)


def merge_into_path(
    rows: DataFrame,
    path: str,
    *,
    partition_cols: Sequence[str],
    keys: Sequence[str],
    latest: Sequence[str],
) -> None:
    """Merge ``rows`` into a dataset; the merged partitions are completed beside it before any is replaced.

    What a run that died while replacing has left there is put in place by the next run, first of all.
    """
    spark, ahead = rows.sparkSession, f"{path.rstrip('/')}.merging"
    if path_exists(spark, f"{ahead}/_SUCCESS"):
        merged = spark.read.schema(rows.schema).parquet(ahead)
        writers.write_parquet(merged, path, partition_cols=partition_cols)
    remove_path(spark, ahead)
    new = stage(rows, "merge-new")
    merge_batch(new, path, ahead, partition_cols=partition_cols, keys=keys, latest=latest)
    remove_path(spark, ahead)


#: A task of a merge takes about this many rows of a partition; a key may repeat in it up to so often.
PIECE_ROWS, FREQUENT_ROWS, KEY_BUCKETS = 250_000, 1_000_000, 4096
_BUCKET, PIECE, _SPOT = "_bucket", "_piece", "_spot"


def beside(rows: DataFrame, small: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """``rows`` joined with ``small`` by ``columns``, in which NULL equals NULL; keeps the columns of ``rows`` first."""
    other = small.withColumnsRenamed({c: f"_t_{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in columns])
    return rows.join(other, same, how).drop(*[f"_t_{c}" for c in columns])


def pieces_of(counted: DataFrame, partition_cols: Sequence[str]) -> tuple[DataFrame, int]:
    """How many pieces each partition is dealt out in, and the number of all rows, from counts in ``rows``."""
    pieces = stage(
        counted.groupBy(*partition_cols).agg(F.ceil(F.sum("rows") / PIECE_ROWS).alias("_pieces"), F.sum("rows").alias("rows")),
        "merge-pieces",
    )
    return pieces.drop("rows"), pieces.agg(F.sum("rows")).first()[0] or 0


def dealt_out(
    rows: DataFrame, pieces: DataFrame, total: int, partition_cols: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Rows by partition and piece, which is a column ``_piece``; those of a partition with equal ``keys`` stay together.

    ``pieces`` and ``total`` are what ``pieces_of`` returns. Where there are more pieces than shuffle partitions, each
    has a task, however well its rows are compressed.
    """
    both = beside(rows, pieces, partition_cols, "left")
    piece = F.pmod(F.xxhash64(*keys), F.coalesce("_pieces", F.lit(1)))
    tasks, usual = -(-total // PIECE_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.withColumn(PIECE, piece).drop("_pieces").repartition(*([tasks] if tasks > usual else []), *partition_cols, PIECE)


def _merged(
    new: DataFrame,
    stored: DataFrame,
    partition_cols: Sequence[str],
    keys: Sequence[str],
    latest: Sequence[str],
    tie_break: Sequence[Column] | None,
    size: Callable[[int], None],
) -> DataFrame:
    """The latest row per key of new rows and the stored partitions they touch, dealt out as they are written.

    One shuffle serves both the de-duplication and the write: rows go by partition and piece, and a key is
    always in one piece of one partition. Rows of keys that repeat very often are cut by a group limit before.
    ``size`` is told how many rows there are.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    sizes = stage(
        new.groupBy(*partition_cols, bucket.alias(_BUCKET)).agg(F.count("*").alias("rows")), "merge-sizes"
    )
    old = in_touched_partitions(stored, sizes, partition_cols)
    counted = sizes.drop(_BUCKET).unionByName(old.groupBy(*partition_cols).agg(F.count("*").alias("rows")))
    pieces, total = pieces_of(counted, partition_cols)
    size(total)
    ties = content_order(new.unionByName(old, allowMissingColumns=True)) if tie_break is None else tie_break
    frequent = sizes.filter(F.col("rows") > FREQUENT_ROWS)
    if not frequent.isEmpty():
        at = [*partition_cols, _BUCKET]
        frequent, by_bucket = frequent.select(*at), new.withColumn(_BUCKET, bucket)
        cut = dedup_latest(beside(by_bucket, frequent, at, "left_semi"), keys, latest, ties)
        new = beside(by_bucket, frequent, at, "left_anti").unionByName(cut).drop(_BUCKET)
    dealt = dealt_out(new.unionByName(old, allowMissingColumns=True), pieces, total, partition_cols, keys)
    # Sorted by a number first, of which the upper bits are the piece: texts are compared for equal keys only, and
    # rows of a partition stay next to each other for the write.
    at = F.shiftleft(F.pmod(F.xxhash64(*partition_cols, PIECE), F.lit(1 << 15)), 48)
    spot = at.bitwiseOR(F.xxhash64(*keys).bitwiseAND(F.lit((1 << 48) - 1)))
    by = list(dict.fromkeys([_SPOT, *partition_cols, PIECE, *keys]))
    return dedup_latest(dealt.withColumn(_SPOT, spot), by, latest, ties).drop(PIECE, _SPOT)


def merged_with_table(
    spark: SparkSession,
    table: str,
    build: Callable[[], DataFrame],
    schema: T.StructType,
    partition_cols: Sequence[str],
    keys: Sequence[str],
    latest: Sequence[str],
    *,
    tie_break: Sequence[Column] | None = None,
    run_id: str | None = None,
    path: str | None = None,
    staged: bool = True,
) -> bool:
    """Merge the rows of ``build()`` into a table by ``keys``; False if the run was applied before.

    The table's partition columns must follow from ``keys``. ``staged=False`` leaves out the copy of the new
    rows: they are then computed two or three times, and must come out the same each time.
    """
    if spark.catalog.tableExists(table):
        partition_cols = versions.partition_columns(spark, table)

    def merged() -> DataFrame:
        new = stage(build(), "merge-new") if staged else build()
        return _merged(new, spark.table(table), partition_cols, keys, latest, tie_break, size)

    with sized_shuffles(spark) as size:
        return versions.replace_partitions(
            spark, table, merged, schema, partition_cols, run_id=run_id, path=path, spread=False
        )


def batch_run(checkpoint: str, batch_id: int) -> str:
    """The name of a batch as a run of the table that it goes to; names sort by batch."""
    return f"{sha256(checkpoint.encode()).hexdigest()[:16]}-{batch_id:012d}"


def ingest_into_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None,
    *,
    partition_cols: Sequence[str] = ("region", "trending_date_parsed"),
    keys: Sequence[str] = tuple(DEDUP_KEYS),
    latest: Sequence[str] = ("_processed_at",),
    tie_break: Sequence[Column] | None = None,
    path: str | None = None,
) -> list[str]:
    """Merge everything that is new into a catalog table; returns the runs that were applied.

    Without a ``transform`` rows are merged as they are read, and are not copied before.

    ``partition_cols`` must follow from ``keys``. ``checkpoint`` is the stream's bookmark: files are taken
    once, and a batch that is repeated after a crash, or by a checkpoint set back, changes nothing.
    """
    runs: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id, rows = batch_run(checkpoint, batch_id), transform(batch) if transform else batch
        with staging(batch.sparkSession):
            if merged_with_table(
                batch.sparkSession, table, lambda: rows, rows.schema, partition_cols, keys, latest,
                tie_break=tie_break, run_id=run_id, path=path, staged=transform is not None,
            ):
                runs.append(run_id)

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return runs


def ingest_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    partition_cols: Sequence[str] = ("region", "trending_date_parsed"),
    keys: Sequence[str] = tuple(DEDUP_KEYS),
    latest: Sequence[str] = ("_processed_at",),
    tie_break: Sequence[Column] | None = None,
) -> int:
    """Merge everything that is new into ``path``; returns the number of rows merged in.

    ``partition_cols`` must follow from ``keys``, so that a key never changes partition;
    partitioning by day keeps what a batch rewrites as small as what it brings.
    """

    sizes: list[int] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        # Used several times by the merge; persisting keeps files from being parsed again.
        rows = transform(batch).persist()
        try:
            sizes.append(rows.count())
            merge_batch(
                rows,
                path,
                f"{checkpoint}/merged/batch={batch_id}",
                partition_cols=partition_cols,
                keys=keys,
                latest=latest,
                tie_break=tie_break,
            )
        finally:
            rows.unpersist()
        # This batch is in place, so the one before will not be replayed any more.
        remove_path(batch.sparkSession, f"{checkpoint}/merged/batch={batch_id - 1}")

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(sizes)


def ingest_reference(
    spark: SparkSession, source: str, path: str, checkpoint: str, *, multi_line: bool = True
) -> DataFrame | None:
    """Load category documents that have arrived since the last run.

    Each loaded region replaces its stored partition, so replays change nothing. Returns
    error rows for the unusable files of this run, None if there was nothing new.
    """
    stream = files.with_lineage(
        file_stream(
            spark, source, "json", files.REFERENCE_DOCUMENT,
            options=files.document_options(multi_line),
        )
    )
    failed: list[DataFrame] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        documents = batch.persist()
        try:
            load = load_reference(documents)
            writers.write_parquet(load.rows, path)
            failed.append(stage(load.errors, "reference-errors"))
        finally:
            documents.unpersist()

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return reduce(DataFrame.unionByName, failed) if failed else None


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(file_path, batch) of the files that a stream has taken, from the log that its source keeps."""
    entry = F.from_json("value", "path string, batchId long")
    entries = spark.read.text(f"{checkpoint}/sources/0").select(entry.alias("e")).filter("e.path IS NOT NULL")
    path = F.regexp_replace(decode_file_path(F.col("e.path")), "^file:/+", "file:/")
    return entries.select(path.alias("file_path"), F.col("e.batchId").alias("batch")).distinct()


def ingest_json_lines(
    spark: SparkSession, source: str, path: str, checkpoint: str, schema: T.StructType, *, partition_cols: Sequence[str]
) -> DataFrame | None:
    """Append the sound records of JSON files that have arrived since the last run to ``path``.

    Returns error rows (see ``sources.manifest``) for the files of this run, None if there was nothing
    new. The stream's log says which files it has taken, so that one of which no line came is named as
    well. A batch that is repeated writes its own folder again, ``<path>/batch=…``.
    """
    text = T.StructType([T.StructField("value", T.StringType())])
    options = {"ignoreCorruptFiles": "true", "recursiveFileLookup": "true"}
    stream = file_stream(spark, source, "text", text, options=options)
    lines = stream.select("value", F.col("_metadata.file_path").alias("file_path"))
    before = -1
    if path_exists(spark, f"{checkpoint}/sources/0"):
        before = taken_files(spark, checkpoint).agg(F.max("batch")).first()[0]
    staged: list[DataFrame] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        records = stage(manifest.parse_lines(batch, schema), "json-lines")
        sound = records.filter(manifest.usable()).select(*schema.fieldNames(), "file_path")
        writers.write_parquet(sound, f"{path}/batch={batch_id}", partition_cols=partition_cols, mode="overwrite")
        staged.append(records)

    query = (
        lines.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not staged:
        return None
    new = taken_files(spark, checkpoint).filter(F.col("batch") > before).select("file_path")
    there = manifest.delivered_files(spark, source).join(new, "file_path", "left_semi")
    return stage(manifest.file_errors(reduce(DataFrame.unionByName, staged), there), "json-errors")
