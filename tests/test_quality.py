from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from samples import csv_frame
from tidemark.operators import quality
from tidemark.operators.reference import load_reference
from tidemark.plans.medallion import Layers, gated, run_medallion
from tidemark.sources import files

NOW = dt.datetime(2026, 3, 2, 14)


def as_of():
    return F.lit("2026-03-02 14:00:00").cast("timestamp")

TABLE = quality.STATISTICS
SCHEMA = ("video_id string, title string, channel_title string, views long, region string, "
          "_processed_at timestamp")


def table(spark, n=12, title_nulls=0, views=100, age_hours=1):
    data = [
        (f"v{i}", None if i < title_nulls else "T", "C", views if i == 0 else 5, "us",
         NOW - dt.timedelta(hours=age_hours))
        for i in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA)


def failing(df, name=TABLE):
    results = quality.run_checks(df, name, as_of=as_of())
    return sorted({r.check for r in quality.failures(results).collect()})


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, []),
        ({"n": 10}, []),
        ({"n": 9}, ["row_count"]),
        ({"title_nulls": 1}, ["null_pct"]),
        ({"n": 20, "title_nulls": 1}, []),
        ({"views": -1}, ["value_range"]),
        ({"views": 50_000_000_001}, ["value_range"]),
        ({"views": 50_000_000_000}, []),
        ({"age_hours": 48}, []),
        ({"age_hours": 49}, ["freshness"]),
        ({"n": 0}, ["freshness", "row_count"]),
    ],
)
def test_each_broken_table_fails_its_own_check(spark, change, expected):
    assert failing(table(spark, **change)) == expected


def test_missing_column_fails_nulls_and_schema(spark):
    assert failing(table(spark).drop("region")) == ["null_pct", "schema"]


def test_freshness_variants(spark):
    base = table(spark)
    assert failing(base.drop("_processed_at")) == []
    iso = base.drop("_processed_at").withColumn(
        "_ingestion_timestamp", F.lit("2026-03-02T13:00:00+00:00")
    )
    assert failing(iso) == []
    assert failing(iso.withColumn("_ingestion_timestamp", F.lit("2026-02-01T00:00:00Z"))) == [
        "freshness"
    ]
    assert failing(iso.withColumn("_ingestion_timestamp", F.lit("soon"))) == []
    nothing = F.lit(None).cast("timestamp")
    assert failing(base.withColumn("_processed_at", nothing)) == ["freshness"]


def test_rows_and_messages(spark):
    results = quality.run_checks(table(spark, title_nulls=1, views=-1), TABLE, as_of=as_of())
    assert results.schema.simpleString() == quality.DQ_RESULTS.simpleString()
    got = {(r.check, r.column): r for r in results.collect()}
    assert got["row_count", None].message == "row_count; value 12.0; threshold 10.0"
    title = got["null_pct", "title"]
    assert (title.value, title.threshold) == (8.33, 5.0)
    assert title.message == "null_pct; column title; value 8.33; threshold 5.0"
    views = got["value_range", "views"]
    assert (views.negative_count, views.extreme_count) == (1, 0)
    assert got["schema", None].missing_columns == []


def test_other_tables_have_no_range_check(spark):
    results = quality.run_checks(table(spark, views=-1), "something", as_of=as_of())
    assert sorted(r.check for r in results.collect()) == ["freshness", "row_count", "schema"]


def test_checks_cost_one_aggregate(spark):
    plan = quality.run_checks(table(spark), TABLE, as_of=as_of())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate(keys=[]") == 2 and text.count("Exchange") == 1


def test_unreadable_table_does_not_stop_the_others(spark):
    table(spark).createOrReplaceTempView("dq_present")
    results = quality.check_tables(
        spark, {TABLE: "dq_present", quality.REFERENCE: "dq_absent"}, as_of=as_of()
    )
    assert [r.table for r in quality.failures(results).collect()] == [quality.REFERENCE]
    summary = quality.summarize(results).first()
    assert (summary.quality_passed, summary.checks_passed, summary.checks_total) == (False, 9, 10)
    assert len(summary.details) == 10
    sampled = quality.check_tables(spark, {TABLE: "dq_present"}, as_of=as_of(), sample_limit=5)
    assert [r.check for r in quality.failures(sampled).collect()] == ["row_count"]


def test_unreadable_files_do_not_stop_the_others(spark, tmp_path):
    table(spark).createOrReplaceTempView("dq_present")
    broken = tmp_path / "broken"
    spark.range(1).selectExpr("'v' as video_id", "1L as views").write.parquet(str(broken))
    for part in broken.glob("*.parquet"):
        part.write_bytes(b"no parquet")
    for crc in broken.glob(".*.crc"):
        crc.unlink()
    spark.read.schema("video_id string, views long").parquet(str(broken)).createOrReplaceTempView("dq_broken")
    results = quality.check_tables(
        spark, {quality.REFERENCE: "dq_broken", TABLE: "dq_present"}, as_of=as_of()
    )
    bad = [(r.table, r.check) for r in quality.failures(results).collect()]
    assert bad == [(quality.REFERENCE, "read_table")]
    assert results.filter(F.col("table") == TABLE).count() == 9


def test_checks_without_a_probe_run_nothing(spark):
    seen = Observation("seen")
    table(spark).observe(seen, F.count("*").alias("n")).createOrReplaceTempView("dq_lazy")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    results = quality.check_tables(spark, {TABLE: "dq_lazy", quality.REFERENCE: "dq_absent"}, as_of=as_of(), probe=False)
    assert len(tracker.getJobIdsForGroup()) == before
    assert [r.check for r in quality.failures(results).collect()] == ["read_table"]
    assert seen.get["n"] == 12


def test_gate(spark):
    good = quality.run_checks(table(spark), TABLE, as_of=as_of())
    bad = quality.run_checks(table(spark, views=-1), TABLE, as_of=as_of())
    assert gated(good, "gold") == "gold"
    assert gated(bad, "gold") is None
    assert not quality.quality_passed(good.limit(0))


def test_warnings_name_nonzero_counters_only():
    assert quality.warn_on_profile({"nulls_title": 2, "negative_views": 0}) == ["nulls_title: 2"]


def reference_documents(spark, base):
    (base / "region=us").mkdir(parents=True, exist_ok=True)
    items = ",".join(
        f'{{"id": "{i}", "snippet": {{"title": "Cat {i}", "assignable": true}}}}'
        for i in range(1, 13)
    )
    (base / "region=us" / "c.json").write_text(f'{{"items": [{items}]}}')
    return load_reference(files.read_reference_json(spark, str(base)))


def test_whole_run_and_its_gate(spark, tmp_path):
    good = csv_frame(spark, *[{"video_id": f"v{i}"} for i in range(12)])
    layers = Layers(silver_db="s1", gold_db="g1")
    docs = reference_documents(spark, tmp_path / "ref")
    first = run_medallion(spark, [good], docs, layers, job_name="j")
    assert first.quality_passed and first.gold_built
    names = {r.category_name for r in spark.table("g1.category_analytics").collect()}
    assert names == {"Cat 10"}
    before = spark.table("g1.trending_analytics").drop("_aggregated_at").collect()
    run_medallion(spark, [good], docs, layers, job_name="j")
    assert spark.table("g1.trending_analytics").drop("_aggregated_at").collect() == before
    bad = csv_frame(spark, *[{"video_id": f"v{i}", "views": "-5"} for i in range(12)])
    gate = Layers(silver_db="s2", gold_db="g2", root=str(tmp_path / "lake"))
    stopped = run_medallion(spark, [bad], None, gate, job_name="j")
    assert not stopped.quality_passed and not stopped.gold_built
    assert not spark.catalog.tableExists("g2.trending_analytics")
    stored = quality.failures(spark.table("s2.dq_results"))
    assert [r.check for r in stored.collect()] == ["value_range"]
