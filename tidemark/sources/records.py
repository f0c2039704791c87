"""Splitting of delivered CSV whose quoted fields hold line breaks, and of mixed character sets.

A CSV parser has to start at the top of such a file, as it cannot tell whether a line in the middle
stands inside quotes. Here files are divided into pieces like any text, and where records begin follows
from counting quotes:

1. One scan of the lines counts the quotes of each piece (and whether its bytes are UTF-8): one row a piece.
2. A running sum of these counts over the pieces of a file says which pieces begin inside quotes.
3. A second scan cuts every piece at the line ends outside quotes. What a piece cannot complete, the
   end of a record that began before it and the beginning of one that goes on after it, is put together
   by a third scan of the pieces concerned only; it is at most two texts a piece.

Records then are parsed one by one, by as many tasks as there are pieces. Lines end with a line feed, or a
carriage return and a line feed; in files of the latter kind such ends inside quotes become line feeds, as in the
CSV source. Quotes are counted wherever they stand, so fields that hold one must be quoted,
with inner quotes doubled. A quote that is never closed makes one record of the rest of its file.

Character sets come with the first scan: lines are cut as bytes, as quotes and line feeds are the same
bytes in UTF-8 and ISO-8859-1, and each record is decoded by its file's flag. So all files are read the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

_HEAD, _MIDDLE, _TAIL = 0, 1, 2


def read_lines(spark: SparkSession, path: str | list[str], partition_cols: tuple[str, ...]) -> DataFrame:
    """Lines as bytes, in order within a task, with their file and where its piece begins."""
    fields = [T.StructField(c, T.StringType()) for c in ("value", *partition_cols)]
    lines = spark.read.schema(T.StructType(fields)).option("lineSep", "\n").text(path)
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        *partition_cols,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.col("_metadata.file_block_length").alias("length"),
    )


def scan_pieces(lines: DataFrame) -> DataFrame:
    """(file_path, piece, inside, open, is_utf8, crlf): a piece begins, and ends, inside quotes; its file is
    in UTF-8, and its lines end, going by the first one, with a carriage return too."""
    text = F.col("value").cast("string")
    quotes = F.length("value") - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    counted = lines.groupBy("file_path", "piece", "length").agg(
        F.sum(quotes).alias("quotes"),
        F.bool_and(F.is_valid_utf8(text)).alias("is_utf8"),
        # Lines of a piece come in order within one task.
        F.first(F.endswith(text, F.lit("\r"))).alias("crlf"),
    )
    own = Window.partitionBy("file_path")
    through = F.sum("quotes").over(own.orderBy("piece"))
    return counted.select(
        "file_path",
        "piece",
        "length",
        ((through - F.col("quotes")) % 2 == 1).alias("inside"),
        (through % 2 == 1).alias("open"),
        F.bool_and("is_utf8").over(own).alias("is_utf8"),
        F.first("crlf").over(own.orderBy("piece")).alias("crlf"),
    )


def _cut(
    batches: Iterator[pa.RecordBatch], carried: list[str], fragments: bool
) -> Iterator[tuple[pa.Array, int, bool, pa.RecordBatch]]:
    """Records of one piece, or a fragment at its end, with its kind, whether the first one is its file's
    first record, and a row of the piece."""
    held: list[pa.Array] = []  # lines of a record that is not complete yet
    key, odd, started, top, own = None, 0, False, False, None

    def joined(parts: list[pa.Array]) -> pa.Array:
        return pa.array([b"\n".join(x for part in parts for x in part.to_pylist())], pa.binary())

    for batch in batches:
        lines, piece_id, inside = (batch.column(c) for c in ("value", "piece_id", "inside"))
        piece_id = piece_id.to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(piece_id)) + 1, [len(piece_id)]]).tolist()
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if lo == hi:
                continue
            if piece_id[lo] != key:
                if held and fragments:
                    yield joined(held), _TAIL if started else _MIDDLE, top, own
                key, held, own = piece_id[lo], [], batch.slice(lo, 1).select(carried)
                top = own.column("piece")[0].as_py() == 0
                odd, started = int(inside[lo].as_py()), not inside[lo].as_py()
            run = lines.slice(lo, hi - lo)
            quotes = pc.count_substring(run, '"').to_numpy(zero_copy_only=False)
            after = (odd + np.cumsum(quotes)) % 2
            odd = int(after[-1])
            ends = np.flatnonzero(after == 0) + 1
            if not len(ends):
                held.append(run)
                continue
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(offsets, run.slice(0, int(ends[-1]))), b"\n")
            if held:
                first = joined([*held, run.slice(0, int(ends[0]))])
                records = pa.concat_arrays([first, records.slice(1)])
            if not started:
                # What ends here began in an earlier piece.
                if fragments:
                    yield records.slice(0, 1), _HEAD, False, own
                records, started = records.slice(1), True
            if not fragments:
                yield records, _HEAD, top, own
            top = False
            held = [run.slice(int(ends[-1]))] if ends[-1] < hi - lo else []
    if held and fragments:
        yield joined(held), _TAIL if started else _MIDDLE, top, own


def _mapped(lines: DataFrame, fragments: bool) -> DataFrame:
    """Records within the lines' pieces, or the fragments at their ends, with what a piece's lines share."""
    carried = [c for c in lines.columns if c not in ("value", "inside", "open", "piece_id")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for records, kind, top, own in _cut(batches, carried, fragments):
            n = len(records)
            shared = own.take(pa.array(np.zeros(n, np.int64)))
            first = np.arange(n) == 0 if top else np.zeros(n, bool)
            columns = [records, pa.array(np.full(n, kind, np.int32)), pa.array(first), *shared.columns]
            yield pa.RecordBatch.from_arrays(columns, ["record", "kind", "top", *carried])

    own = {"record": T.BinaryType(), "kind": T.IntegerType(), "top": T.BooleanType()}
    fields = [T.StructField(name, dtype) for name, dtype in own.items()]
    return lines.mapInArrow(run, T.StructType(fields + [lines.schema[c] for c in carried]))


def _assembled(fragments: DataFrame, shared: list[str]) -> DataFrame:
    """Records that lie in several pieces: from the beginning of each on, in order of the pieces."""
    order = Window.partitionBy("file_path").orderBy("piece", "kind")
    chains = fragments.withColumn("chain", F.sum(F.when(F.col("kind") == _TAIL, 1).otherwise(0)).over(order))
    part = F.struct("piece", "kind", F.col("record").cast("string").alias("text"))
    texts = F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"])
    return chains.groupBy("file_path", "chain").agg(
        F.array_join(texts, "\n").cast("binary").alias("record"),
        F.bool_or("top").alias("top"),
        *[F.first(c).alias(c) for c in shared],
    )


def read_records(
    spark: SparkSession,
    path: str | list[str],
    *,
    partition_cols: tuple[str, ...] = ("region",),
    only: Column | None = None,
    header: bool = True,
) -> DataFrame:
    """Text of each record (``record``), with the partition columns and ``file_path``.

    The first record of a file is left out as its ``header``, and so are records without any text.
    ``only`` is a condition on the partition columns, which prunes folders.
    One small job runs at once: the scan of the pieces. Its result is broadcast for the other scans,
    at a row for each piece, about a hundred bytes for 128 MB of input. Should Spark divide the files
    otherwise by then, as it can where cores come and go and there are few files, the read fails.
    """
    lines = read_lines(spark, path, partition_cols)
    if only is not None:
        lines = lines.filter(only)
    pieces = F.broadcast(stage(scan_pieces(lines), "csv-pieces"))
    # Spark divides files by their sizes and by the cores it has; other cores, other pieces.
    other = F.raise_error("files are divided otherwise than when quotes were counted: read them again")
    inside = F.when(F.col("inside").isNull(), other).otherwise(F.col("inside"))
    known = lines.join(pieces, ["file_path", "piece", "length"], "left").withColumns(
        {"inside": inside, "piece_id": F.xxhash64("file_path", "piece")}
    )
    shared = ["is_utf8", "crlf", *partition_cols]
    wanted = known.select("value", "inside", "open", "piece_id", "file_path", "piece", *shared)
    whole = _mapped(wanted, fragments=False)
    cut = _mapped(wanted.filter(F.col("inside") | F.col("open")), fragments=True)
    columns = ["record", "top", "file_path", *shared]
    records = whole.select(*columns).union(_assembled(cut, shared).select(*columns))
    if header:
        records = records.filter(~F.col("top"))
    text = F.when(F.col("is_utf8"), F.col("record").cast("string")).otherwise(F.decode("record", "ISO-8859-1"))
    bare = F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)
    bare = F.when(F.col("crlf"), F.replace(bare, F.lit("\r\n"), F.lit("\n"))).otherwise(bare)
    return records.select(bare.alias("record"), *partition_cols, "file_path").filter(F.col("record") != "")


def parse_record(schema: T.StructType, options: dict[str, str]) -> Column:
    """The fields of ``record`` as a struct, under the options of the CSV source."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(F.col("record"), ddl, {**options, "multiLine": "true"})
