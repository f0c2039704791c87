from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Event

import pytest

from samples import SILVER, day, silver_frame
from tidemark.session import path_exists, scratch_path, stage, staging
from tidemark.sources import writers
from tidemark.streaming import incremental

FIRST = [("v1", "A", 1, "us", day(1), 10, 1), ("v2", "A", 1, "us", day(2), 10, 1),
         ("v3", "A", 1, "gb", None, 10, 1)]
SECOND = [("v1", "A", 1, "us", day(1), 20, 1), ("v3", "A", 1, "gb", None, 5, 1),
          ("v4", "A", 1, "us", day(1), 1, 1)]
MERGED = [("gb", "v3", 10), ("us", "v1", 20), ("us", "v2", 10), ("us", "v4", 1)]


@pytest.fixture
def load(spark, tmp_path):
    landing, stored, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run(*records):
        if records:
            silver_frame(spark, *records).write.mode("append").parquet(landing)
        stream = incremental.file_stream(spark, landing, "parquet", SILVER)
        return incremental.ingest_available(
            stream, stored, checkpoint, lambda b: b, latest=("views",)
        )

    run.stored, run.checkpoint = stored, checkpoint
    return run


def test_two_loads_equal_one_batch_and_a_third_does_nothing(spark, load, rows):
    assert load(*FIRST) == 3
    assert load(*SECOND) == 3
    read = lambda: rows(spark.read.parquet(load.stored), "region", "video_id", "views")
    assert read() == MERGED
    assert load() == 0
    assert read() == MERGED


def test_partitions_a_batch_does_not_touch_are_left_alone(spark, load):
    load(*FIRST)
    day_two = Path(load.stored) / "region=us" / f"trending_date_parsed={day(2)}"
    files = lambda: sorted(p.name for p in day_two.glob("*.parquet"))
    before = files()
    load(*SECOND)
    assert files() == before


def merge(batch, path, staged):
    incremental.merge_batch(
        batch, path, staged,
        partition_cols=("region", "trending_date_parsed"),
        keys=("video_id", "region", "trending_date_parsed"), latest=("views",),
    )


def test_replay_after_a_crash_while_replacing(spark, tmp_path, rows):
    path, staged = str(tmp_path / "out"), str(tmp_path / "stage")
    merge(silver_frame(spark, *FIRST), path, staged + "/0")
    second = silver_frame(spark, *SECOND)
    merge(second, path, staged + "/1")
    # the crash: a partition is in an unusable state, its merged rows are staged
    half = silver_frame(spark, ("half", "A", 1, "us", day(1), 7, 1))
    writers.write_parquet(half, path, partition_cols=("region", "trending_date_parsed"))
    merge(second, path, staged + "/1")
    assert rows(spark.read.parquet(path), "region", "video_id", "views") == MERGED


def test_thousands_of_touched_partitions_still_prune(spark, tmp_path):
    path = str(tmp_path / "out")
    merge(silver_frame(spark, *FIRST), path, str(tmp_path / "stage"))
    batch = silver_frame(
        spark, ("v1", "A", 1, "us", day(1), 1, 1), *[(f"v{i}", "A", 1, f"r{i}", day(1 + i % 28), 1, 1) for i in range(3000)]
    )
    old = incremental.stored_rows(batch, path, ("region", "trending_date_parsed"))
    plan = old._jdf.queryExecution().executedPlan().toString()
    # The plan's text is cut off after the first of the two filters.
    assert re.search(r"PartitionFilters: \[region#\d+ INSET r0, r1", plan)
    assert [r.video_id for r in old.collect()] == ["v1"]


def test_partitions_touched_are_read_exactly(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    merge(silver_frame(spark, *FIRST), path, str(tmp_path / "stage"))
    # (us, 1) and (gb, none): their combinations also name (us, none) and (gb, 1).
    old = incremental.stored_rows(silver_frame(spark, *SECOND), path, ("region", "trending_date_parsed"))
    assert rows(old, "video_id") == [("v1",), ("v3",)]


def test_staging_of_two_threads_is_kept_apart(spark):
    started, release = Event(), Event()

    def other():
        with staging(spark):
            kept = stage(spark.range(5), "other")
            started.set()
            release.wait(60)
            return kept.count()

    with ThreadPoolExecutor() as pool:
        waiting = pool.submit(other)
        started.wait(60)
        with staging(spark):
            mine = stage(spark.range(3), "mine")
            assert mine.count() == 3
        release.set()
        assert waiting.result() == 5
    assert not path_exists(spark, mine.inputFiles()[0])


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    assert not path_exists(spark, scratch_path(spark, "x"))


def test_reference_files_are_loaded_once_each(spark, tmp_path, rows):
    source, stored, checkpoint = (str(tmp_path / n) for n in ("ref", "out", "cp"))

    def put(region, name, body):
        folder = tmp_path / "ref" / f"region={region}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(body)

    def document(title):
        return f'{{"items": [{{"id": "1",\n "snippet": {{"title": "{title}"}}}}]}}'

    def load():
        return incremental.ingest_reference(spark, source, stored, checkpoint)

    def names():
        return rows(spark.read.parquet(stored), "region", "category_name")

    put("us", "a.json", document("Film"))
    put("gb", "a.json", document("Film"))
    put("de", "a.json", "{")
    assert [r.error for r in load().collect()] == ["malformed JSON document"]
    assert names() == [("gb", "Film"), ("us", "Film")]
    assert load() is None
    put("us", "b.json", document("Movies"))
    assert load().count() == 0
    assert names() == [("gb", "Film"), ("us", "Movies")]


class _Conf:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_without_a_setting():
    local = _Conf(**{"spark.master": "local[4]"})
    assert "tidemark-scratch" in scratch_path(local, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Conf(**{"spark.master": "yarn"}), "x")
    for master in ("", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(_Conf(**{"spark.master": master}), "x")
