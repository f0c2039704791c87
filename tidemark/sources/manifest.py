"""Which delivered files a load could use, and why not the others.

A load that skips what it cannot read loses files without a word. Here the files delivered (listed, not
read) and those that were expected are held against the files that rows came from, and whatever is
left over becomes an error row with a reason:

* ``missing``: expected, but not delivered, or without a byte, as Spark does not list such files;
* ``empty``: blank lines only;
* ``undecodable``: bytes that are no UTF-8;
* ``malformed``: text of which some records do not parse;
* ``unreadable``: bytes that the file system or the decompression cannot give out, so that no row came.

All of it is joins on the file's path, so lists of files never pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import decode_file_path
from ..session import stage
from .files import CORRUPT

#: Reasons in the order in which they are looked for.
MISSING, EMPTY, UNDECODABLE, MALFORMED, UNREADABLE = "missing", "empty", "undecodable", "malformed", "unreadable"


def delivered_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file_path, length, modified) of all files below ``path``; their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return listed.select(F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*") -> DataFrame:
    """Records of JSON files, a line each, with their file; what cannot be read gives no rows, and no failure.

    ``is_utf8`` and ``blank`` tell of each line whether its bytes are text, and whether there is any;
    ``_corrupt_record`` has lines that do not parse.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .text(path)
    )
    return parse_lines(lines.select("value", F.col("_metadata.file_path").alias("file_path")), schema)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``value`` and ``file_path`` of lines, of a batch or a stream, as records."""
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    valid, blank = F.is_valid_utf8("value"), F.trim("value") == ""
    record = F.from_json(F.when(valid, F.col("value")), declared, {"columnNameOfCorruptRecord": CORRUPT})
    path = decode_file_path(F.col("file_path"))
    judged = lines.select(record.alias("r"), valid.alias("is_utf8"), blank.alias("blank"), path.alias("file_path"))
    return judged.select("r.*", "is_utf8", "blank", "file_path")


def usable() -> Column:
    """Whether a record of ``read_json_lines`` is sound."""
    return F.col("is_utf8") & ~F.col("blank") & F.col(CORRUPT).isNull()


def file_errors(
    records: DataFrame, delivered: DataFrame, expected: DataFrame | None = None
) -> DataFrame:
    """(file_path, reason, bad_records) for every file that is not sound.

    ``delivered`` has file_path and length; ``expected``, if given, file_path. ``bad_records`` counts the
    records that were left out, and is null where none could be told apart.
    """
    read = records.groupBy("file_path").agg(
        F.count_if(~F.col("is_utf8")).alias("undecodable"),
        F.count_if(F.col("is_utf8") & ~F.col("blank") & F.col(CORRUPT).isNotNull()).alias("malformed"),
        F.bool_and("blank").alias("blank"),
    )
    judged = delivered.select("file_path", "length").join(read, "file_path", "left")
    if expected is not None:
        judged = judged.join(expected.select("file_path", F.lit(True).alias("wanted")), "file_path", "full")
    bad = F.col("undecodable") + F.col("malformed")
    reason = (
        F.when(F.col("length").isNull(), MISSING)
        .when(F.col("blank"), EMPTY)
        .when(F.col("undecodable") > 0, UNDECODABLE)
        .when(F.col("malformed") > 0, MALFORMED)
        .when(bad.isNull(), UNREADABLE)
    )
    return judged.select("file_path", reason.alias("reason"), bad.alias("bad_records")).filter("reason IS NOT NULL")


def load_with_errors(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    expected: DataFrame | None = None,
    pattern: str = "*",
) -> tuple[DataFrame, DataFrame]:
    """(sound records with their ``file_path``, error rows) of the JSON files below ``path``.

    Files are parsed once: the records are staged, and rows and errors are taken from there.
    """
    records = stage(read_json_lines(spark, path, schema, pattern), "manifest")
    errors = file_errors(records, delivered_files(spark, path, pattern), expected)
    return records.filter(usable()).select(*schema.fieldNames(), "file_path"), errors
