from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from samples import SILVER, csv_frame, day, silver_frame
from tidemark import session
from tidemark.operators import marts
from tidemark.plans import increments, silver
from tidemark.plans.medallion import Layers
from tidemark.sources import versions, writers
from tidemark.streaming import incremental

FIRST = [("v1", "A", 1, "us", day(1), 10, 1), ("v2", "A", 1, "us", day(2), 10, 1),
         ("v3", "A", 1, "gb", None, 10, 1), ("v5", "B", 2, "us", day(1), 3, 1), ("v6", "B", 3, None, day(1), 4, 2)]
SECOND = [("v1", "A", 1, "us", day(1), 20, 1), ("v3", "A", 1, "gb", None, 5, 1),
          ("v4", "A", 1, "us", day(1), 1, 1), ("v2", "C", 2, "us", day(3), 7, 1), ("v5", "C", 2, "us", day(1), 9, 0)]


@pytest.fixture
def lake(spark, tmp_path):
    db = f"lake_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / db}'")
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def load(*records):
        if records:
            silver_frame(spark, *records).write.mode("append").parquet(landing)
        stream = incremental.file_stream(spark, landing, "parquet", SILVER)
        return incremental.ingest_into_table(stream, f"{db}.stats", checkpoint, lambda b: b, latest=("views",))

    load.db, load.table, load.checkpoint = db, f"{db}.stats", tmp_path / "cp"
    yield load
    spark.sql(f"DROP DATABASE {db} CASCADE")


def refresh(spark, lake, lookup=None, **how):
    return increments.refresh_gold(spark, lake.table, lambda n: f"{lake.db}.{n}", lookup, **how)


def same(rows, df, other):
    columns = [c for c in other.columns if c != "_aggregated_at"]
    assert rows(df, *columns) == rows(other, *columns)


def test_batches_go_into_the_table_once(spark, lake, rows):
    first = lake(*FIRST)
    second = lake(*SECOND)
    assert len(first) == len(second) == 1 and lake() == []
    once = rows(spark.table(lake.table))
    # The checkpoint loses its last commit: the batch comes again under the same name.
    shutil.rmtree(lake.checkpoint / "commits")
    assert lake() == []
    assert rows(spark.table(lake.table)) == once
    assert ("v1", 20) in rows(spark.table(lake.table), "video_id", "views")


def test_a_crash_while_switching_is_finished_by_the_next_run(spark, lake, rows, monkeypatch):
    lake(*FIRST)
    point, calls = versions._point, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        point(*args)

    monkeypatch.setattr(versions, "_point", dies)
    with pytest.raises(Exception, match="lost"):
        lake(*SECOND)
    monkeypatch.setattr(versions, "_point", point)
    lake()
    got = rows(spark.table(lake.table), "video_id", "region", "trending_date_parsed", "views")
    best = {}
    for v, _, _, r, d, views, _ in [*FIRST, *SECOND]:
        best[v, r, d] = max(best.get((v, r, d), 0), views)
    assert got == sorted(((*k, n) for k, n in best.items()), key=repr)


def test_gold_follows_silver_by_touched_partitions(spark, lake, rows):
    names = spark.createDataFrame([("1", "One"), ("2", "Two")], "id string, snippet_title string")
    for records in (FIRST, SECOND):
        runs = lake(*records)
        assert refresh(spark, lake, names) == runs
    assert refresh(spark, lake, names) == []
    stats = spark.table(lake.table)
    lookup = increments.category_lookup(names)
    same(rows, spark.table(f"{lake.db}.trending_analytics"), marts.trending_analytics(stats))
    same(rows, spark.table(f"{lake.db}.category_analytics"), marts.category_analytics(stats, lookup))
    same(rows, spark.table(f"{lake.db}.channel_analytics"), marts.channel_analytics(stats, lookup))
    # New names reach the days that no run has touched.
    more = names.unionByName(spark.createDataFrame([("3", "Three")], names.schema))
    refresh(spark, lake, more, renamed=True)
    again = increments.category_lookup(more)
    same(rows, spark.table(f"{lake.db}.category_analytics"), marts.category_analytics(stats, again))
    same(rows, spark.table(f"{lake.db}.channel_analytics"), marts.channel_analytics(stats, again))


def test_gold_reads_touched_partitions_of_silver_only(spark, lake):
    lake(*FIRST)
    touched = versions.partitions_of(spark, lake.table, versions.open_runs(spark, lake.table, "gold"), ["region", "trending_date_parsed"])
    assert touched.count() == 4
    changed = incremental.in_touched_partitions(spark.table(lake.table), touched, ["region", "trending_date_parsed"])
    plan = marts.daily_grain(changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "region#" in plan.split("PartitionFilters: [")[1][:60]


def test_a_refresh_that_dies_is_repeated(spark, lake, rows, monkeypatch):
    lake(*FIRST)
    real, done = versions.replace_partitions, []

    def dies(spark_, table, *args, **kwargs):
        if len(done) == 4:
            raise RuntimeError("lost")
        done.append(table)
        return real(spark_, table, *args, **kwargs)

    monkeypatch.setattr(versions, "replace_partitions", dies)
    with pytest.raises(RuntimeError, match="lost"):
        refresh(spark, lake)
    monkeypatch.setattr(versions, "replace_partitions", real)
    lake(*SECOND)
    assert len(refresh(spark, lake)) == 2
    stats = spark.table(lake.table)
    same(rows, spark.table(f"{lake.db}.channel_analytics"), marts.channel_analytics(stats, None))
    numbers = spark.table(f"{lake.db}.video_numbers")
    assert numbers.count() == numbers.select("region", "number").distinct().count() == 6


def test_distinct_videos_over_several_bitmaps(spark, rows):
    stats = spark.range(100_000).select(
        F.concat(F.lit("v"), F.col("id") % 70_000).alias("video_id"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("channel_title"),
        F.lit("us").alias("region"),
        (F.col("id") % 5).alias("part"),
    )
    numbers = marts.new_videos(stats, None)
    assert rows(numbers.selectExpr("min(number)", "max(number)", "count(DISTINCT number)")) == [(1, 70_000, 70_000)]
    bitmaps = marts.video_bitmaps(stats, numbers, ["part"])
    want = stats.groupBy("channel_title", "region").agg(F.count_distinct("video_id").alias("total_videos"))
    assert rows(marts.distinct_videos(bitmaps)) == rows(want)
    later = marts.new_videos(stats.withColumn("video_id", F.concat("video_id", F.lit("x"))), numbers)
    assert rows(later.selectExpr("min(number)", "max(number)")) == [(70_001, 140_000)]


def test_whole_incremental_run_and_its_gate(spark, tmp_path, rows):
    layers = Layers(silver_db="inc_s", gold_db="inc_g", root=str(tmp_path / "lake"))
    source, checkpoint = str(tmp_path / "csv"), str(tmp_path / "bookmarks")
    schema = csv_frame(spark, {}).schema

    def run(*records):
        if records:
            csv_frame(spark, *records).write.mode("append").parquet(source)
        stream = incremental.file_stream(spark, source, "parquet", schema)
        return increments.run_incremental(spark, [stream], None, layers, checkpoint=checkpoint, job_name="j")

    loaded, passed, built = run(*[{"video_id": f"v{i}"} for i in range(12)])
    assert len(loaded) == 1 and passed and built == loaded
    # Bad rows stop Gold, and go there with the next run that passes.
    loaded, passed, built = run({"video_id": "bad", "views": "-5"})
    assert len(loaded) == 1 and not passed and built == []
    loaded, passed, built = run({"video_id": "bad", "views": "5"}, {"video_id": "new", "trending_date": "17.15.11"})
    assert len(loaded) == 1 and passed and len(built) == 2
    assert sum(r.total_videos for r in spark.table("inc_g.trending_analytics").collect()) == 14
    assert run() == ([], True, [])


def test_silver_runs_with_a_name_are_applied_once(spark, tmp_path):
    writers.create_database(spark, "named_runs")
    how = {"job_name": "j", "table": "named_runs.stats", "path": str(tmp_path / "t")}
    frame = csv_frame(spark, {"video_id": "v1"}, {"video_id": "v2"})
    assert silver.run_bronze_to_silver([frame], run_id="monday", **how).rows_written == 2
    assert silver.run_bronze_to_silver([frame], run_id="monday", **how).rows_written == 0
    assert spark.table("named_runs.stats").count() == 2


def test_a_crash_while_replacing_paths_is_finished_by_the_next_run(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "silver")
    how = {"job_name": "j", "path": path}
    silver.run_bronze_to_silver([csv_frame(spark, {"video_id": "v1"}, {"video_id": "v2", "region": "gb"})], **how)
    real = writers.write_parquet

    def dies(df, *args, **kwargs):
        # Dynamic overwriting removes partitions before it puts the new ones in place.
        shutil.rmtree(tmp_path / "silver" / "region=us")
        raise RuntimeError("lost")

    monkeypatch.setattr(writers, "write_parquet", dies)
    with pytest.raises(RuntimeError, match="lost"):
        silver.run_bronze_to_silver([csv_frame(spark, {"video_id": "v3"})], **how)
    monkeypatch.setattr(writers, "write_parquet", real)
    silver.run_bronze_to_silver([csv_frame(spark, {"video_id": "v4"})], **how)
    assert rows(spark.read.parquet(path), "region", "video_id") == [
        ("gb", "v2"), ("us", "v1"), ("us", "v3"), ("us", "v4"),
    ]


def test_checks_from_kept_counters_equal_checks_on_all_rows(spark, lake, rows):
    from tidemark.operators import quality

    for records in (FIRST, SECOND, ()):
        lake(*records)
        kept = increments.refresh_profile(spark, lake.table, f"{lake.db}.profile")
        want = quality.run_checks(spark.table(lake.table), quality.STATISTICS)
        assert rows(kept) == rows(want)
    assert spark.table(f"{lake.db}.profile").count() == 6


def test_observed_checks_need_no_second_read(spark, tmp_path, rows):
    from tidemark.operators import quality

    for name, frame in (("some", silver_frame(spark, *FIRST)), ("none", silver_frame(spark, *FIRST).limit(0))):
        watched, checks = quality.observed_checks(frame, quality.STATISTICS)
        watched.write.parquet(str(tmp_path / name))
        assert rows(checks()) == rows(quality.run_checks(frame, quality.STATISTICS))


def test_bitmaps_take_no_more_than_their_videos(spark, rows):
    # Videos of a channel lie far apart, as many channels share them.
    stats = spark.range(200_000).select(
        F.concat(F.lit("v"), F.col("id")).alias("video_id"),
        F.concat(F.lit("c"), F.xxhash64("id") % 500).alias("channel_title"),
        F.lit("us").alias("region"),
    )
    numbers = stats.select("region", "video_id", F.substr("video_id", F.lit(2)).cast("bigint").alias("number"))
    bitmaps = marts.video_bitmaps(stats, numbers, [])
    stored = bitmaps.agg(F.count("*"), F.sum(F.octet_length(F.to_binary(F.hex("videos"), F.lit("hex"))))).first()
    assert stored[0] <= 200_000 and stored[1] <= 8 * 200_000
    assert marts.distinct_videos(bitmaps).agg(F.sum("total_videos")).first()[0] == 200_000


def test_a_merge_shuffles_rows_once_however_often_keys_repeat(spark, lake, rows, monkeypatch):
    spread, staged = [], []
    real, stage = versions.spread_by, incremental.stage
    monkeypatch.setattr(versions, "spread_by", lambda *a: spread.append(a) or real(*a))
    monkeypatch.setattr(incremental, "stage", lambda df, name: staged.append(name) or stage(df, name))
    monkeypatch.setattr(incremental, "FREQUENT_ROWS", 2)
    monkeypatch.setattr(incremental, "PIECE_ROWS", 2)
    often = [("v9", "A", 1, region, day(1), i, 1) for i in range(40) for region in ("us", None)]
    both = [[*FIRST, *often], [*SECOND, ("v9", "A", 1, None, day(1), 99, 1)]]
    best = {}
    for records in both:
        silver_frame(spark, *records).write.mode("append").parquet(f"{lake.checkpoint}-in")
        stream = incremental.file_stream(spark, f"{lake.checkpoint}-in", "parquet", SILVER)
        incremental.ingest_into_table(stream, lake.table, str(lake.checkpoint), None, latest=("views",))
        for v, _, _, r, d, views, _ in records:
            best[v, r, d] = max(best.get((v, r, d), 0), views)
    got = rows(spark.table(lake.table), "video_id", "region", "trending_date_parsed", "views")
    assert got == sorted(((*k, n) for k, n in best.items()), key=repr)
    assert spread == [] and "merge-new" not in staged


def test_daily_marts_come_from_totals_of_categories(spark, rows):
    records = [*FIRST, ("v7", "B", 1, "us", day(1), 2, 1), ("v8", None, 1, "us", day(1), 2, 1), ("v9", "B", None, "us", day(1), 6, 0),
               ("w1", None, None, None, None, 7, 1), ("w2", "B", 3, None, None, 8, 1)]
    grain = marts.daily_grain(silver_frame(spark, *records).repartition(3))
    lookup = increments.category_lookup(spark.createDataFrame([("1", "One"), ("3", "One")], "id string, snippet_title string"))
    by_category = marts.category_days(grain)
    days = marts.trending_from_categories(by_category, marts.daily_channels(grain))
    same(rows, days, marts.trending_from_grain(grain))
    for names in (lookup, None):
        want = marts.category_from_grain(increments.attach_category_names(grain, names))
        same(rows, marts.category_from_categories(by_category, names), want)
    # Neither is made by expanding the grain for each thing that is counted.
    for mart in (days, marts.category_from_categories(by_category, lookup)):
        assert "Expand" not in mart._jdf.queryExecution().executedPlan().toString()


def test_daily_marts_with_categories_that_become_one(spark, lake, rows):
    frame = silver_frame(spark, *FIRST, ("v7", "A", 4, "us", day(1), 2, 1))
    texts = frame.withColumn("category_id", F.when(F.col("category_id") == 4, "01").otherwise(F.col("category_id").cast("string")))
    texts.write.parquet(f"{lake.checkpoint}-in")
    stream = incremental.file_stream(spark, f"{lake.checkpoint}-in", "parquet", texts.schema)
    incremental.ingest_into_table(stream, lake.table, str(lake.checkpoint), None, latest=("views",))
    names = spark.createDataFrame([("1", "One"), ("2", "Two")], "id string, snippet_title string")
    refresh(spark, lake, names)
    stats, lookup = spark.table(lake.table), increments.category_lookup(names)
    same(rows, spark.table(f"{lake.db}.category_analytics"), marts.category_analytics(stats, lookup))
    same(rows, spark.table(f"{lake.db}.trending_analytics"), marts.trending_analytics(stats))


def test_grain_and_bitmaps_go_where_they_are_written_in_one_shuffle(spark, lake, rows, monkeypatch):
    spread, real, dealt = [], versions.spread_by, incremental.dealt_out
    tasks = []
    monkeypatch.setattr(versions, "spread_by", lambda df, by: spread.append(df.columns) or real(df, by))
    monkeypatch.setattr(incremental, "PIECE_ROWS", 1)
    monkeypatch.setattr(session, "TASK_ROWS", 1)

    def watched(*args):
        tasks.append(spark.conf.get("spark.sql.shuffle.partitions"))
        return dealt(*args)

    monkeypatch.setattr(increments, "dealt_out", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for records in (FIRST, SECOND, [("v6", "B", 3, None, day(1), 9, 2), ("v8", None, None, "us", day(1), 2, 1)]):
        lake(*records)
        refresh(spark, lake)
    assert not [c for c in spread if "bucket" in c or "n_views" in c]
    # Shuffles have as many partitions as their rows need, and the session's number is back after them.
    assert len(tasks) >= 6 and int(tasks[-1]) > int(before) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    stats = spark.table(lake.table)
    same(rows, spark.table(f"{lake.db}.daily_grain"), marts.daily_grain(stats))
    same(rows, spark.table(f"{lake.db}.trending_analytics"), marts.trending_analytics(stats))
    same(rows, spark.table(f"{lake.db}.category_analytics"), marts.category_analytics(stats, None))
    same(rows, spark.table(f"{lake.db}.channel_analytics"), marts.channel_analytics(stats, None))


def test_the_number_of_shuffle_partitions_comes_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError, match="lost"), session.sized_shuffles(spark) as size:
        size(10)
        assert spark.conf.get(key) == before
        size(session.TASK_ROWS * 1000 + 1)
        assert spark.conf.get(key) == "1001"
        raise RuntimeError("lost")
    assert spark.conf.get(key) == before


def test_sets_of_categories_are_made_from_few_rows(spark, rows):
    records = [*FIRST, *[(f"w{i}", "A", i % 2, "us", day(1 + i % 9), i, 1) for i in range(40)], ("v8", None, None, None, None, 2, 1)]
    stats = silver_frame(spark, *records)
    names = spark.createDataFrame([("1", "One"), ("0", "One")], "id string, snippet_title string")
    few = marts.channel_categories(marts.daily_grain(stats))
    assert few.count() == stats.select("channel_title", "region", "category_id").distinct().count()
    lookup = increments.category_lookup(names)
    counts = marts.distinct_videos(marts.video_bitmaps(stats, marts.new_videos(stats, None), []))
    got = marts.channel_from_categories(increments.attach_category_names(few, lookup), counts)
    same(rows, marts.ranked_channels(got), marts.channel_analytics(stats, lookup))


def test_days_of_very_many_rows_are_aggregated_before_they_are_dealt_out(spark, lake, rows, monkeypatch):
    monkeypatch.setattr(incremental, "FREQUENT_ROWS", 5)
    dealt, real = [], incremental.dealt_out

    def watched(df, *args):
        dealt.append(rows(df, "n_videos") if "n_videos" in df.columns else None)
        return real(df, *args)

    monkeypatch.setattr(increments, "dealt_out", watched)
    lake(*FIRST, *[(f"w{i}", None, None, "us", None, i, 1) for i in range(30)], *[(f"x{i}", "A", 1, None, day(1), i, 1) for i in range(30)])
    refresh(spark, lake)
    stats = spark.table(lake.table)
    # Rows of the two large days come as rows of the grain: one, and two of different channels.
    assert dealt == [None, [(1,), (30,), (30,)], None]
    same(rows, spark.table(f"{lake.db}.daily_grain"), marts.daily_grain(stats))
    same(rows, spark.table(f"{lake.db}.trending_analytics"), marts.trending_analytics(stats))
    same(rows, spark.table(f"{lake.db}.channel_analytics"), marts.channel_analytics(stats, None))
