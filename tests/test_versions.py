from __future__ import annotations

import datetime

import pytest

from tidemark.session import remove_path
from tidemark.sources import versions

SCHEMA = "id long, region string, day date"
COLS = ["region", "day"]


@pytest.fixture
def table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS versioned")
    name = f"versioned.t_{abs(hash(str(tmp_path)))}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def day(n):
    return datetime.date(2024, 1, n)


def frame(spark, *rows):
    return spark.createDataFrame([(i, r, None if d is None else day(d)) for i, r, d in rows], SCHEMA)


def put(spark, table, df, **how):
    return versions.replace_partitions(spark, table, lambda: df, df.schema, COLS, **how)


def stored(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=repr)


FIRST = [(1, "us", 1), (2, "us", 2), (3, "it's a/b=c\\", 1), (4, None, 1), (5, "us", None), (6, "é +%20", 3)]


def rows_of(*rows):
    return sorted(((i, r, None if d is None else day(d)) for i, r, d in rows), key=repr)


def test_a_run_replaces_its_own_partitions_only(spark, table, tmp_path):
    assert put(spark, table, frame(spark, *FIRST), path=str(tmp_path / "t"))
    assert stored(spark, table) == rows_of(*FIRST)
    second = [(10, "us", 1), (11, None, 1), (12, "us", None), (13, "it's a/b=c\\", 1), (14, "gb", 9)]
    put(spark, table, frame(spark, *second))
    assert stored(spark, table) == rows_of((2, "us", 2), (6, "é +%20", 3), *second)
    plan = spark.table(table).filter("region = 'us'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_a_crash_between_two_partitions_loses_nothing(spark, table, tmp_path, monkeypatch):
    put(spark, table, frame(spark, *FIRST), path=str(tmp_path / "t"))
    second = frame(spark, (1, "us", 1), (20, "us", 1), (2, "us", 2), (21, "us", 2), (3, "it's a/b=c\\", 1))
    point, calls = versions._point, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        point(*args)

    monkeypatch.setattr(versions, "_point", dies)
    with pytest.raises(RuntimeError, match="lost"):
        put(spark, table, second, run_id="second")
    monkeypatch.setattr(versions, "_point", point)
    # What a reader sees now: every partition is whole, old or new.
    seen = {tuple(r) for r in stored(spark, table)}
    assert {(i, r, d) for i, r, d in rows_of(*FIRST)} <= seen
    # Any next run finishes it first, and the same run is not applied again.
    assert not put(spark, table, second, run_id="second")
    want = rows_of(*FIRST, (20, "us", 1), (21, "us", 2))
    assert stored(spark, table) == want


def test_a_crash_while_writing_changes_nothing(spark, table, tmp_path):
    root = str(tmp_path / "t")
    put(spark, table, frame(spark, *FIRST), path=root)
    half = f"{root}/{versions.RUNS}/half"
    frame(spark, (99, "us", 1)).write.partitionBy(*COLS).parquet(half)
    remove_path(spark, f"{half}/{versions.COMPLETE}")
    assert versions.finish_runs(spark, table, COLS) == []
    assert stored(spark, table) == rows_of(*FIRST)
    assert put(spark, table, frame(spark, (7, "us", 1)), run_id="half")
    assert (99, "us", day(1)) not in stored(spark, table)


def test_runs_are_applied_once(spark, table):
    assert put(spark, table, frame(spark, (1, "us", 1)), run_id="a")
    assert put(spark, table, frame(spark, (2, "us", 1)), run_id="b")
    assert not put(spark, table, frame(spark, (1, "us", 1)), run_id="a")
    assert stored(spark, table) == rows_of((2, "us", 1))


def test_empty_runs_and_new_columns(spark, table):
    put(spark, table, frame(spark))
    assert stored(spark, table) == []
    wider = frame(spark, (1, "us", 1)).selectExpr("id", "id * 2 AS twice", "region", "day")
    put(spark, table, frame(spark, (5, "gb", 1)))
    put(spark, table, wider)
    got = {(r.id, r.twice) for r in spark.table(table).collect()}
    assert got == {(1, 2), (5, None)}


def test_superseded_folders_go_and_rows_stay(spark, table):
    put(spark, table, frame(spark, *FIRST))
    put(spark, table, frame(spark, (10, "us", 1), (11, None, 1)))
    before = stored(spark, table)
    assert versions.drop_superseded(spark, table) == 2
    assert versions.drop_superseded(spark, table) == 0
    spark.catalog.refreshTable(table)
    assert stored(spark, table) == before
