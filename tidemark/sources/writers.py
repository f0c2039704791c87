"""Writers for all layers, table registration, and Bronze landing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text
from ..schemas import BRONZE_STATISTICS_COLUMNS

def spread_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of each output directory together without making one huge task.

    REBALANCE lets the adaptive planner split a hot partition value over many tasks and
    merge small ones, where ``repartition(columns)`` would tie each value to one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_cols: Sequence[str] = ("region",),
    mode: str = "partitions",
) -> None:
    """Snappy Parquet, partitioned.

    ``mode``: ``partitions`` replaces only the partitions present in ``df`` (rerunning
    is idempotent), ``overwrite`` replaces everything, ``append`` adds.
    """
    if mode not in ("partitions", "overwrite", "append"):
        raise ValueError(f"unknown write mode: {mode}")
    writer = (
        spread_by(df, partition_cols)
        .write.mode("append" if mode == "append" else "overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic" if mode == "partitions" else "static")
    )
    writer.partitionBy(*partition_cols).parquet(path)


@contextmanager
def _partition_overwrite(spark: SparkSession, mode: str) -> Iterator[None]:
    """Set the session's overwrite mode; an option would be stored with the table."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_table(
    df: DataFrame,
    table: str,
    *,
    path: str | None = None,
    partition_cols: Sequence[str] = ("region",),
    mode: str = "partitions",
) -> None:
    """Like ``write_parquet`` but registered in the catalog.

    Columns the table lacks are added to it; columns ``df`` lacks are written as NULL.
    """
    spark = df.sparkSession
    if mode not in ("partitions", "overwrite", "append"):
        raise ValueError(f"unknown write mode: {mode}")
    if mode == "overwrite" or not spark.catalog.tableExists(table):
        writer = (
            spread_by(df, partition_cols)
            .write.format("parquet")
            .mode("overwrite")
            .option("compression", "snappy")
            .partitionBy(*partition_cols)
        )
        with _partition_overwrite(spark, "static"):
            (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    evolve_table(spark, table, df)
    known = set(df.columns)
    ordered = spread_by(df, partition_cols).select(
        *[
            F.col(f"`{f.name}`") if f.name in known
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
    )
    with _partition_overwrite(spark, "dynamic"):
        ordered.write.insertInto(table, overwrite=mode == "partitions")


def evolve_table(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """Add the columns of ``df`` that the table does not have yet."""
    known = set(spark.table(table).columns)
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        rendered = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({rendered})")
    return [f.name for f in new]


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a dataset whose files were written with differing column sets."""
    return spark.read.option("mergeSchema", True).parquet(path)


def union_evolving(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name; columns one side lacks are NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def create_database(spark: SparkSession, name: str, path: str | None = None) -> None:
    where = f" LOCATION {sql_literal(path)}" if path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    *,
    ddl: str,
    fmt: str = "parquet",
    partition_cols: Sequence[str] = ("region",),
    options: dict[str, str] | None = None,
    partitions: Iterable[Sequence[str | None]] | None = None,
) -> DataFrame:
    """(Re)create a table over existing files with the partitions that are named, or else with all found.

    ``partitions`` lists values in the order of ``partition_cols``, spelt as the folders are. Naming them
    spares the listing of the whole dataset, and keeps out folders that are not meant.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rendered = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(
        f"CREATE TABLE {table} ({ddl}) USING {fmt}"
        + (f" OPTIONS ({rendered})" if rendered else "")
        + (f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else "")
        + f" LOCATION '{path}'"
    )
    if partitions is not None:
        add_partitions(spark, table, [(partition_spec(partition_cols, p), None) for p in partitions])
    elif partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def sql_literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(partition_cols: Sequence[str], values: Sequence[str | None]) -> str:
    return ", ".join(f"`{c}`={sql_literal(v)}" for c, v in zip(partition_cols, values, strict=True))


def add_partitions(spark: SparkSession, table: str, new: Sequence[tuple[str, str | None]]) -> None:
    """Enter partitions that the catalog does not have yet: (specification, folder if not the usual one)."""
    for lo in range(0, len(new), 500):
        parts = [
            f"PARTITION ({spec})" + (f" LOCATION {sql_literal(folder)}" if folder else "")
            for spec, folder in new[lo : lo + 500]
        ]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts)}")


def _metadata(region: Column, at: Column, source: str, *extra: Column) -> Column:
    return F.struct(
        dates.ingestion_id(at).alias("ingestion_id"),
        region.alias("region"),
        dates.iso_stamp(at).alias("ingestion_timestamp"),
        *extra,
        F.lit(source).alias("source"),
    ).alias("_pipeline_metadata")


def landed_videos(documents: DataFrame, at: Column, source: str) -> DataFrame:
    """Fetched video documents (``region``, ``items``) with metadata and partitions."""
    region = text.normalize_region(F.col("region"))
    count = text.item_count(F.col("items")).alias("video_count")
    return documents.select(
        *[F.col(c) for c in documents.columns if c != "region"],
        _metadata(region, at, source, count),
        region.alias("region"),
        dates.day_stamp(at).alias("date"),
        dates.hour_stamp(at).alias("hour"),
    )


def landed_reference(documents: DataFrame, at: Column, source: str) -> DataFrame:
    """Fetched category documents with metadata and partitions."""
    region = text.normalize_region(F.col("region"))
    return documents.select(
        *[F.col(c) for c in documents.columns if c != "region"],
        _metadata(region, at, source),
        region.alias("region"),
        dates.day_stamp(at).alias("date"),
    )


def land_videos(documents: DataFrame, path: str, at: Column, source: str) -> None:
    """Append video documents as JSON under region=/date=/hour=."""
    folders = ("region", "date", "hour")
    landed = spread_by(landed_videos(documents, at, source), folders)
    landed.write.mode("append").partitionBy(*folders).json(path)


def land_reference(documents: DataFrame, path: str, at: Column, source: str) -> None:
    """Write category documents as JSON under region=/date=, replacing a rerun's own."""
    folders = ("region", "date")
    landed = spread_by(landed_reference(documents, at, source), folders)
    landed.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*folders).json(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    partition_cols: Sequence[str] = ("region",),
    mode: str = "errorifexists",
    encoding: str = "UTF-8",
) -> None:
    """CSV with header and doubled-quote escaping, in the dialect the readers expect."""
    writer = (
        spread_by(df, partition_cols)
        .write.mode(mode)
        .option("encoding", encoding)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    (writer.partitionBy(*partition_cols) if partition_cols else writer).csv(path)


def write_repaired_csv(df: DataFrame, path: str) -> None:
    """Repaired statistics, one record per line. Never give it the path being read."""
    write_csv(df.select(*BRONZE_STATISTICS_COLUMNS, "region"), path)


def write_json_lines(
    df: DataFrame, path: str, *, partition_cols: Sequence[str] = ()
) -> None:
    """One document per line, UTF-8, non-ASCII characters unescaped."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).json(path)


def rewrite_json_lines(
    spark: SparkSession, source: str, target: str, *, partition_cols: Sequence[str] = ("region",)
) -> DataFrame:
    """Rewrite documents, one per file, one per line; returns (folders, file_path) of those that are no JSON.

    Documents are rewritten as text, so fields that no schema declares are kept. The
    rewritten files can be split and read without ``multiLine``.
    """
    value = [T.StructField("value", T.StringType())]
    folders = [T.StructField(c, T.StringType()) for c in partition_cols]
    documents = (
        spark.read.schema(T.StructType([*value, *folders]))
        .option("wholetext", True)
        .format("text")
        .load(source)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )
    rendered = text.minify_json(F.col("value"))
    writer = (
        documents.select(rendered.alias("value"), *partition_cols)
        .filter(F.col("value").isNotNull())
        .write.mode("errorifexists")
    )
    (writer.partitionBy(*partition_cols) if partition_cols else writer).text(target)
    return documents.filter(rendered.isNull()).select(*partition_cols, "file_path")
