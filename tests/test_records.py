from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from samples import VIDEO
from tidemark import schemas
from tidemark.sources import files, records

COLUMNS = schemas.BRONZE_STATISTICS_COLUMNS


def quoted(value):
    return '"' + value.replace('"', '""') + '"' if set(value) & set('",\r\n') else value


def awkward(rng):
    parts = ["plain", 'say "so"', "a,b", "\n", "\r\n", "\n\n", '"', "é", "中", " ", "", "\\", '\n"\n']
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))


def put(folder, rng, n, *, name, ending="\n", encoding="utf-8", close=True):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(COLUMNS)]
    for i in range(n):
        v = {**VIDEO, "video_id": f"{name}-{i}", "description": awkward(rng), "tags": awkward(rng)}
        if encoding != "utf-8":
            v = {k: x.replace("中", "ü") for k, x in v.items()}
        lines.append(",".join(quoted(v[c]) for c in COLUMNS) + (",extra" if i % 17 == 5 else ""))
        if i % 13 == 4:
            lines.append("")
        if i % 19 == 7:
            lines.append("short,line")
    (folder / name).write_bytes((ending.join(lines) + (ending if close else "")).encode(encoding))


@pytest.fixture
def small_pieces(spark):
    """Files are cut into pieces of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(2))
def test_split_files_have_the_rows_of_whole_ones(spark, rows, tmp_path, small_pieces, seed):
    rng = random.Random(seed)
    put(tmp_path / "region=us", rng, 90, name="a.csv")
    put(tmp_path / "region=us", rng, 40, name="b.csv", ending="\r\n")
    put(tmp_path / "region=gb", rng, 1, name="c.csv", close=False)
    put(tmp_path / "region=gb", rng, 0, name="d.csv")
    path = str(tmp_path)

    def read(**how):
        # A malformed line is kept as it stands or with its line ends unified.
        return files.read_text_csv(spark, path, **how).withColumn(files.CORRUPT, F.regexp_replace(files.CORRUPT, "\r\n", "\n"))

    assert rows(read(splittable=True)) == rows(read())
    typed = files.read_statistics_csv(spark, path, splittable=True)
    assert rows(typed) == rows(files.read_statistics_csv(spark, path))
    assert typed.rdd.getNumPartitions() > 10
    only = files.read_statistics_csv(spark, path, splittable=True, regions=["GB"])
    assert rows(only) == rows(files.read_statistics_csv(spark, path, regions=["gb"]))


def test_one_record_over_many_pieces(spark, tmp_path, small_pieces):
    rng = random.Random(5)
    long = "\n".join(awkward(rng).replace('"', "'") for _ in range(2_000))
    put(tmp_path / "region=us", rng, 20, name="a.csv")
    with open(tmp_path / "region=us" / "a.csv", "ab") as f:
        for i in range(2):
            v = {**VIDEO, "video_id": f"long{i}", "description": long}
            f.write((",".join(quoted(v[c]) for c in COLUMNS) + "\n").encode())
    got = files.read_text_csv(spark, str(tmp_path), splittable=True).filter("video_id LIKE 'long%'").collect()
    assert sorted((r.video_id, r.description) for r in got) == [("long0", long), ("long1", long)]


def test_character_sets_are_told_apart_by_file(spark, rows, tmp_path, small_pieces):
    rng = random.Random(6)
    put(tmp_path / "region=us", rng, 80, name="a.csv")
    put(tmp_path / "region=us", rng, 80, name="b.csv", encoding="latin-1")
    put(tmp_path / "region=fr", rng, 40, name="c.csv", encoding="latin-1", ending="\r\n")
    path = str(tmp_path)
    want = files.read_any_charset(spark, path, lambda p, enc: files.read_text_csv(spark, p, encoding=enc))
    got = files.read_text_csv(spark, path, splittable=True)
    columns = [c for c in got.columns if c != files.CORRUPT]
    assert rows(got, *columns) == rows(want, *columns)
    assert got.filter(F.contains("description", F.lit("é"))).count() > 10


def test_an_unclosed_quote_takes_the_rest_of_its_file_only(spark, tmp_path, small_pieces):
    rng = random.Random(7)
    put(tmp_path / "region=us", rng, 30, name="a.csv")
    put(tmp_path / "region=us", rng, 30, name="b.csv")
    whole = records.read_records(spark, str(tmp_path)).filter("file_path LIKE '%b.csv'").count()
    with open(tmp_path / "region=us" / "a.csv", "ab") as f:
        f.write(b'x,"open\n' + b"more\n" * 500)
    got = records.read_records(spark, str(tmp_path))
    assert got.filter("file_path LIKE '%b.csv'").count() == whole
    (last,) = got.filter("record LIKE 'x,%'").collect()
    assert last.record == 'x,"open' + "\nmore" * 500


def test_the_plan_scans_text_only_and_does_not_shuffle_whole_records(spark, tmp_path):
    put(tmp_path / "region=us", random.Random(8), 5, name="a.csv")
    df = files.read_text_csv(spark, str(tmp_path), splittable=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan
    whole = plan.split("Union", 1)[1].split("FileScan text", 1)[0]
    assert "Exchange hashpartitioning" not in whole


def test_files_that_are_divided_otherwise_later_are_not_read_in_part(spark, tmp_path, small_pieces):
    put(tmp_path / "region=us", random.Random(9), 60, name="a.csv")
    df = records.read_records(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2300")
    with pytest.raises(Exception, match="divided otherwise"):
        df.collect()
