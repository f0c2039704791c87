from __future__ import annotations

import json
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import day, silver_frame
from tidemark.operators import enrich, marts, ranking, reference
from tidemark.plans import gold
from tidemark.sources import files

STATS = [
    ("v1", "A", 10, "us", day(1), 100, 10), ("v1", "A", 10, "us", day(2), 200, 10),
    ("v1", "A", 10, "us", day(3), 300, 10), ("v2", "B", 20, "us", day(1), 300, 3),
    ("v3", None, None, "us", day(1), 0, 0), ("v4", "B", 99, "gb", day(1), 0, 0),
    ("v5", "C", 10, "us", day(1), 300, 1), ("v6", "D", 10, "us", None, 5, 1),
]


def lookup_frame(spark):
    return spark.createDataFrame([(10, "Music"), (20, "Comedy")], "category_id long, category_name string")


@pytest.mark.parametrize(
    "schema",
    [
        "id string, `snippet.title` string, region string",
        "id string, snippet_title string, region string",
        "category_id long, category_name string, region string",
    ],
)
def test_lookup_layouts(spark, rows, schema):
    key = int if schema.startswith("category_id") else str
    data = [(key(1), "Film", "us"), (key(1), "Movie", "gb"), (key(2), "Autos", "us"),
            (key(3), None, "us"), (None, "x", "us")]
    lookup = enrich.category_lookup(spark.createDataFrame(data, schema))
    assert rows(lookup) == [(1, "Movie"), (2, "Autos")]


def test_lookup_of_unknown_layout(spark):
    assert enrich.category_lookup(spark.createDataFrame([(1,)], "x int")) is None


def test_enrich_keeps_rows_and_names_the_unmatched(spark, rows):
    stats = silver_frame(spark, *STATS)
    named = enrich.attach_category_names(stats, lookup_frame(spark))
    assert named.count() == len(STATS)
    assert {(r.category_id, r.category_name) for r in named.collect()} == {
        (10, "Music"), (20, "Comedy"), (99, "Unknown"), (None, "Unknown"),
    }
    nothing = enrich.attach_category_names(stats, None)
    assert {r.category_name for r in nothing.collect()} == {"Unknown"}


def test_lookup_join_is_left_to_the_planner(spark, rows):
    stats, lookup = silver_frame(spark, *STATS), lookup_frame(spark)
    named = enrich.attach_category_names(stats, lookup)
    assert "hint" not in named._jdf.queryExecution().logical().toString().lower()
    expected = rows(named, "video_id", "category_name")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        assert rows(enrich.attach_category_names(stats, lookup), "video_id", "category_name") == expected
    finally:
        spark.conf.set(setting, before)


def test_trending_mart(spark):
    mart = marts.trending_analytics(silver_frame(spark, *STATS))
    row = mart.filter((F.col("region") == "us") & (F.col("trending_date_parsed") == day(1))).first()
    assert row.asDict() == {
        "region": "us", "trending_date_parsed": day(1), "total_videos": 4, "total_views": 700,
        "total_likes": 14, "total_dislikes": 0, "total_comments": 0,
        "avg_views_per_video": 175.0, "avg_like_ratio": (10.0 + 1.0 + 0.0 + 0.3333) / 4,
        "avg_engagement_rate": (10.0 + 1.0 + 0.0 + 0.3333) / 4, "max_views": 300,
        "unique_channels": 3, "unique_categories": 2,
    }
    assert mart.count() == 5  # the rows without a date are a group of their own


def test_channel_mart_ranks_and_sets(spark):
    stats = silver_frame(spark, *STATS)
    mart = marts.channel_analytics(stats, lookup_frame(spark))
    got = {(r.region, r.channel_title): r for r in mart.collect()}
    a = got["us", "A"]
    assert (a.total_videos, a.times_trending, a.peak_views) == (1, 3, 300)
    assert (a.first_trending, a.last_trending, a.categories) == (day(1), day(3), ["Music"])
    assert got["us", "D"].times_trending == 0
    ranks = sorted(
        (r.rank_in_region, r.channel_title) for r in got.values() if r.region == "us"
    )
    # B and C tie on views: name order; the nameless channel comes last on views
    assert ranks == [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, None)]
    unnamed = enrich.attach_category_names(stats, lookup_frame(spark))
    same = {(r.region, r.channel_title): r for r in marts.channel_analytics(unnamed).collect()}
    assert same == got
    with pytest.raises(ValueError):
        marts.channel_analytics(stats)


def test_category_mart_shares(spark):
    stats = silver_frame(spark, *STATS)
    mart = marts.category_analytics(stats, lookup_frame(spark))
    got = {(r.region, r.trending_date_parsed, r.category_id): r for r in mart.collect()}
    us = {k[2]: v.view_share_pct for k, v in got.items() if k[:2] == ("us", day(1))}
    assert us == {10: 57.14, 20: 42.86, None: 0.0}
    assert got["gb", day(1), 99].view_share_pct is None  # a day without any views
    assert got["us", None, 10].view_share_pct == 100.0
    assert got["us", day(1), 10].unique_channels == 2
    unnamed = enrich.attach_category_names(stats, None)
    assert {r.category_name for r in marts.category_analytics(unnamed).collect()} == {"Unknown"}


def test_marts_agree_with_silver(spark):
    stats = silver_frame(spark, *STATS)
    total = stats.agg(F.sum("views")).first()[0]
    for mart in (
        marts.trending_analytics(stats),
        marts.channel_totals(stats, None),
        marts.category_analytics(stats, None),
    ):
        assert mart.agg(F.sum("total_views")).first()[0] == total


def test_rank_over_many_slices_with_a_hot_group(spark):
    n = 3000
    data = [("hot" if i % 3 else "cold", i * 7919 % 100, f"c{i:05d}") for i in range(n)]
    data.append((None, 1, "x"))
    df = spark.createDataFrame(data, "region string, views int, name string").repartition(7)
    order = [F.col("views").desc(), F.col("name").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.rank_within(df, ["region"], order, "rank").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = defaultdict(list)
    for r in data:
        expected[r[0]].append(r)
    want = {
        r: i
        for group in expected.values()
        for i, r in enumerate(sorted(group, key=lambda r: (-r[1], r[2])), 1)
    }
    assert {(r.region, r.views, r.name): r.rank for r in ranked} == want
    assert len(ranked) == len(data)


def test_top_channels_is_a_group_limit(spark, rows):
    totals = marts.channel_totals(silver_frame(spark, *STATS), None)
    top = marts.top_channels_by_region(totals, 2)
    assert rows(top, "region", "channel_title", "rank_in_region") == [
        ("gb", "B", 1), ("us", "A", 1), ("us", "B", 2),
    ]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def put_reference(base, name, text, region=None):
    folder = base / f"region={region}" if region else base
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def item(key, title):
    return {"kind": "k", "etag": "e", "id": key,
            "snippet": {"channelId": "ch", "title": title, "assignable": True}}


def test_reference_load_isolates_bad_files(spark, tmp_path, rows):
    us = [item("1", "Film"), item("23", "Comedy"), item("34", "Comedy"), item("1", "Movies"),
          item("29", "Nonprofits & Activism")]
    put_reference(tmp_path, "a b.json", json.dumps({"kind": "x", "items": us}, indent=1), "US")
    put_reference(tmp_path, "b.json", json.dumps({"items": us[:1]}, indent=1), "GB")
    put_reference(tmp_path, "bare.json", json.dumps(item("7", "Bare")))
    put_reference(tmp_path, "empty.json", json.dumps({"items": []}), "CA")
    put_reference(tmp_path, "bad.json", '{"items": [', "DE")
    loaded = reference.load_reference(files.read_reference_json(spark, str(tmp_path)))
    assert rows(loaded.rows, "region", "category_id", "category_name") == [
        ("GB", 1, "Film"), ("US", 1, "Movies"), ("US", 23, "Comedy"),
        ("US", 29, "Nonprofits & Activism"), ("US", 34, "Comedy"), ("unknown", 7, "Bare"),
    ]
    errors = {r._source_file.rsplit("/", 1)[1]: r.error for r in loaded.errors.collect()}
    assert errors == {
        "empty.json": "no category items found", "bad.json": "malformed JSON document",
    }
    counts = {r._source_file.rsplit("/", 1)[1]: r.rows for r in loaded.processed.collect()}
    assert counts == {"a b.json": 4, "b.json": 1, "bare.json": 1}


def test_newest_file_of_a_region_stands(spark, tmp_path, rows):
    import os

    for age, name, title in ((100, "new.json", "New"), (900, "old.json", "Old")):
        put_reference(tmp_path, name, json.dumps({"items": [item("1", title)]}), "US")
        stamp = 1_700_000_000 - age
        os.utime(tmp_path / "region=US" / name, (stamp, stamp))
    documents = files.read_reference_json(spark, str(tmp_path))
    assert rows(reference.load_reference(documents).rows, "category_name") == [("New",)]
    both = reference.load_reference(documents, newest_per_region=False)
    assert rows(both.rows, "category_name") == [("New",), ("Old",)]


def test_reference_documents_of_both_charsets(spark, tmp_path, rows):
    for name, region, encoding in (("a.json", "FR", "latin-1"), ("b.json", "DE", "utf-8")):
        folder = tmp_path / f"region={region}"
        folder.mkdir()
        document = json.dumps({"items": [item("1", "Été")]}, ensure_ascii=False, indent=1)
        (folder / name).write_bytes(document.encode(encoding))
    documents = files.read_any_charset(
        spark, str(tmp_path),
        lambda path, enc: files.read_reference_json(spark, path, encoding=enc),
    )
    loaded = reference.load_reference(documents)
    assert rows(loaded.rows, "region", "category_name") == [("DE", "Été"), ("FR", "Été")]


def test_missing_reference_columns_warn_only():
    assert reference.missing_columns(["id", "snippet.title", "x"]) == set()
    assert reference.missing_columns(["id"]) == {"snippet.title"}


def test_gold_build_matches_single_marts(spark, rows, tmp_path):
    stats = silver_frame(spark, *STATS)
    ref = lookup_frame(spark)
    built = gold.build_gold(stats, ref)
    lookup = enrich.category_lookup(ref)
    for name, mart in (
        ("trending_analytics", marts.trending_analytics(stats)),
        ("channel_analytics", marts.channel_analytics(stats, lookup)),
        ("category_analytics", marts.category_analytics(stats, lookup)),
    ):
        got = getattr(built, name)
        assert got.columns[-1] == "_aggregated_at"
        assert rows(got.drop("_aggregated_at")) == rows(mart)
    path = lambda name: str(tmp_path / name)
    shared = Path(spark.conf.get("spark.checkpoint.dir"), "tidemark")
    before = set(shared.iterdir())
    assert gold.run_silver_to_gold(stats, None, path_of=path)
    assert set(shared.iterdir()) == before  # nothing staged is left behind
    assert spark.read.parquet(path("category_analytics")).count() == 7
    assert not gold.run_silver_to_gold(stats.limit(0), None, path_of=path)


def test_top_k_is_limited_before_the_shuffle_at_any_k(spark):
    df = spark.range(20_000).selectExpr("id % 2 as g", "id as v")
    top = ranking.top_within(df, ["g"], [F.col("v").desc()], 5_000, "rank")
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 10_000
