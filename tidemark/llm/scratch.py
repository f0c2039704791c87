"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path


def with_row(docs: DataFrame) -> DataFrame:
    """``text`` beside one struct of all other columns, so that no name can clash with those of an operator."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "text")


def rows_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``with_row`` has put away."""
    return df.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


#: Frees the shuffle files of a statement when it ends, and not when the driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written in the course of one call.

    ``put`` writes a table that only the call itself reads: it goes when the ``with``
    block ends. ``keep`` writes one that the returned DataFrame still reads: it goes when
    the Spark application ends. Both cut lineage in a form that survives lost executors. The
    shuffle files of a table go as soon as it is written.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self._paths:
            remove_path(self.spark, path)

    def _write(self, df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(self.spark, label)
        conf = self.spark.conf
        before = conf.get(FREE_SHUFFLES, None)
        conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            conf.unset(FREE_SHUFFLES) if before is None else conf.set(FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path), path

    def put(self, df: DataFrame, label: str) -> DataFrame:
        out, path = self._write(df, label)
        self._paths.append(path)
        return out

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        out, path = self._write(df, label)
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(target)
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove a table of ``put`` before the block ends, to hold less disk."""
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove_path(self.spark, path)
