from __future__ import annotations

import gzip

import pytest
from pyspark.sql import types as T

from tidemark.sources import manifest
from tidemark.streaming import incremental

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def deliver(folder):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "good é+1%20.json").write_text('{"id": 1, "name": "a"}\n\n{"id": 2, "name": "é"}\n', "utf-8")
    (folder / "good.json.gz").write_bytes(gzip.compress(b'{"id": 3, "name": "z"}\n'))
    (folder / "half.json").write_text('{"id": 4, "name": "h"}\n{"id": 5, "na\n{"id": "x"}\n', "utf-8")
    (folder / "latin.json").write_bytes('{"id": 6, "name": "é"}\n{"id": 7, "name": "e"}\n'.encode("latin-1"))
    (folder / "broken.json.gz").write_bytes(b"this is no gzip")
    (folder / "cut.json.gz").write_bytes(gzip.compress(b'{"id": 8, "name": "' + b"y" * 9000 + b'"}\n')[:-30])
    (folder / "blank.json").write_bytes(b"\n \n")


REASONS = {
    "half.json": ("malformed", 2),
    "latin.json": ("undecodable", 1),
    "broken.json.gz": ("unreadable", None),
    "cut.json.gz": ("unreadable", None),
    "blank.json": ("empty", 0),
}


def named(errors):
    return {r.file_path.rsplit("/", 1)[1]: (r.reason, r.bad_records) for r in errors.collect()}


def test_every_file_is_read_or_named(spark, tmp_path):
    deliver(tmp_path / "in")
    base = f"file:{tmp_path}/in"
    expected = spark.createDataFrame([(f"{base}/good é+1%20.json",), (f"{base}/never.json",)], "file_path string")
    rows, errors = manifest.load_with_errors(spark, str(tmp_path / "in"), SCHEMA, expected=expected)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3, 4, 7]
    assert named(errors) == REASONS | {"never.json": ("missing", None)}


def test_streams_name_their_files_once(spark, tmp_path):
    deliver(tmp_path / "in")

    def run():
        return incremental.ingest_json_lines(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), SCHEMA, partition_cols=("id",)
        )

    assert named(run()) == REASONS
    assert run() is None
    (tmp_path / "in" / "later.json").write_text("{", "utf-8")
    assert named(run()) == {"later.json": ("malformed", 1)}
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in stored.collect()) == [1, 2, 3, 4, 7]


@pytest.mark.parametrize(("text", "named_files"), [("", []), ("\n", ["a.json"])])
def test_a_delivery_without_records(spark, tmp_path, text, named_files):
    (tmp_path / "a.json").write_text(text)
    rows, errors = manifest.load_with_errors(spark, str(tmp_path), SCHEMA)
    assert rows.count() == 0
    assert list(named(errors)) == named_files
