from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from samples import VIDEO, api_item, csv_frame, flat_frame, write_api_document
from tidemark import schemas
from tidemark.operators import cleanse, dedup, flatten, normalize
from tidemark.plans.repair import run_csv_repair
from tidemark.plans.silver import clean_statistics, run_bronze_to_silver
from tidemark.sources import files
from tidemark.sources.files import CORRUPT



def as_of():
    return F.lit("2026-03-02 14:00:00").cast("timestamp")

COMMON = [c for c in schemas.NORMALIZED_COLUMNS if c != "region"] + ["region"]


def nested_frame(spark, tmp_path, *overrides):
    items = [api_item(**o) for o in overrides]
    write_api_document(tmp_path, "us", "2017-11-14", "06", items)
    return files.read_api_json(spark, str(tmp_path))


def test_shapes_are_told_apart(spark, tmp_path):
    assert normalize.detect_shape(csv_frame(spark, {})) == "csv"
    assert normalize.detect_shape(flat_frame(spark, True, {})) == "flat"
    assert normalize.detect_shape(flat_frame(spark, False, {})) == "flat"
    assert normalize.detect_shape(nested_frame(spark, tmp_path, {})) == "nested"


def test_four_encodings_give_the_same_silver_rows(spark, tmp_path, rows):
    two = ({}, {"video_id": "v2", "views": "7", "title": "é"})
    inputs = [
        csv_frame(spark, *two),
        flat_frame(spark, True, *two),
        flat_frame(spark, False, *two),
        nested_frame(spark, tmp_path, *two),
    ]
    got = [rows(normalize.normalize(i), *COMMON) for i in inputs]
    assert got[0] == got[1] == got[2] == got[3]
    assert len(got[0]) == 2
    everything = normalize.unify(*inputs)
    assert everything.count() == 8
    assert dict(everything.dtypes)["category_id"] == "bigint"


def test_api_fields_that_may_be_absent(spark):
    df = flat_frame(spark, True, {}).drop(
        "statistics.dislikeCount", "snippet.tags", "snippet.thumbnails.default.url"
    )
    row = normalize.normalize(df).first()
    assert (row.dislikes, row.tags, row.thumbnail_link) == (0, None, None)
    assert (row.comments_disabled, row.ratings_disabled) == (False, False)
    with pytest.raises(ValueError, match="snippet.channelTitle"):
        normalize.normalize(df.drop("snippet.channelTitle"))


def test_api_rows_without_date_take_the_ingestion_day(spark):
    df = flat_frame(spark, True, {}).drop("date")
    assert normalize.normalize(df, as_of()).first().trending_date == "26.02.03"


def test_explode_falls_back_to_the_whole_object(spark, rows):
    df = spark.createDataFrame(
        [(1, [("a",), ("b",)], "x"), (2, None, "y"), (3, [], "z")],
        "doc int, items array<struct<id:string>>, id string",
    )
    whole = normalize.explode_items(df, whole=F.struct("id"))
    assert rows(whole, "doc", "position", "item.id") == [
        (1, 0, "a"), (1, 1, "b"), (2, 0, "y"),
    ]
    assert normalize.explode_items(df).count() == 2


def test_cleanse_edges(spark):
    df = csv_frame(
        spark,
        {"video_id": None},
        {"video_id": "null-views", "views": None},
        {"video_id": "junk", "views": "abc", "trending_date": "17.31.02", "region": " US "},
        {"video_id": "fraction", "views": "12.7", "trending_date": "2017-11-14"},
        {"video_id": "flags", "comments_disabled": "TRUE", "ratings_disabled": "false",
         "video_error_or_removed": ""},
        {"video_id": "rates", "views": "3", "likes": "1", "dislikes": "1", "comment_count": "0"},
    )
    silver = clean_statistics(df, job_name="job", as_of=as_of())
    assert silver.columns == schemas.SILVER_COLUMNS
    got = {r.video_id: r for r in silver.collect()}
    assert len(got) == 5
    assert (got["null-views"].views, got["null-views"].like_ratio) == (0, 0.0)
    junk = got["junk"]
    assert (junk.views, junk.trending_date_parsed, junk.region) == (0, None, "us")
    assert got["fraction"].views == 12
    assert got["fraction"].trending_date_parsed == dt.date(2017, 11, 14)
    flags = got["flags"]
    assert (flags.comments_disabled, flags.ratings_disabled, flags.video_error_or_removed) == (
        True, False, None,
    )
    assert (got["rates"].like_ratio, got["rates"].engagement_rate) == (33.3333, 66.6667)
    assert got["rates"]._job_name == "job"


def test_dedup_is_deterministic_and_idempotent(spark, rows):
    records = [
        {"views": "1"}, {"views": "2"}, {"views": "3"},
        {"region": "gb"}, {"trending_date": "17.15.11"},
    ]
    outcomes = set()
    for order in itertools.islice(itertools.permutations(records), 0, 120, 29):
        silver = clean_statistics(csv_frame(spark, *order), job_name="j", as_of=as_of())
        outcomes.add(tuple(rows(silver, "region", "trending_date", "views")))
    assert len(outcomes) == 1 and len(next(iter(outcomes))) == 3
    once = dedup.dedup_latest(silver)
    assert rows(dedup.dedup_latest(once)) == rows(once)


def test_later_ingestion_wins(spark, tmp_path):
    for hour, views in (("06", "1"), ("18", "3"), ("12", "2")):
        write_api_document(tmp_path, "us", "2017-11-14", hour, [api_item(views=views)])
    silver = clean_statistics(files.read_api_json(spark, str(tmp_path)), job_name="j")
    assert [r.views for r in silver.collect()] == [3]


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = dedup.dedup_latest(
        clean_statistics(csv_frame(spark, {}), job_name="j", deduplicate=False)
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_run_reports_counts_and_writes_once(spark, tmp_path):
    df = csv_frame(spark, {}, {}, {"video_id": None}, {"video_id": "v2", "title": None,
                   "views": "-4"})
    path = str(tmp_path / "silver")
    report = run_bronze_to_silver([df], job_name="j", path=path)
    assert (report.rows_read, report.rows_written, report.rows_removed) == (4, 2, 2)
    assert report.profile == {
        "nulls_video_id": 0, "nulls_title": 1, "nulls_channel_title": 0, "nulls_views": 0,
        "negative_views": 1,
    }
    assert spark.read.parquet(path).count() == 2
    run_bronze_to_silver([df], job_name="j", path=path)
    assert spark.read.parquet(path).count() == 2


def test_no_input_writes_nothing(spark, tmp_path):
    report = run_bronze_to_silver(
        [csv_frame(spark, {}).limit(0)], job_name="j", path=str(tmp_path / "s")
    )
    assert report.rows_written == 0 and not (tmp_path / "s").exists()


def raw_text(spark, *overrides, corrupt=None):
    df = csv_frame(spark, *overrides)
    return df.withColumn(CORRUPT, F.lit(corrupt))


def test_repair(spark, rows):
    good = raw_text(
        spark,
        {"description": "  a\r\n\nb ", "comments_disabled": "TRUE"},
        {"video_id": "v2", "category_id": "Music"},
        {"video_id": "v3", "category_id": "10.0"},
    )
    raw = good.unionByName(raw_text(spark, {"video_id": "v4"}, corrupt="1," * 16))
    fixed = cleanse.repair(raw)
    assert rows(fixed, "video_id", "description", "comments_disabled", "category_id") == [
        ("v1", "a b", "true", 10), ("v3", "d", "false", 10),
    ]
    assert rows(cleanse.repair_counts(cleanse.flag_repairs(raw))) == [("us", 3, 1, 1, 2)]


def test_repair_file_round_trip(spark, tmp_path):
    from tidemark.sources import writers

    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    df = csv_frame(spark, {"description": ' x "q"\n\ny, z '}, {"video_id": "v2"})
    writers.write_csv(df, src)
    writers.write_repaired_csv(cleanse.repair(files.read_text_csv(spark, src)), dst)
    again = files.read_statistics_csv(spark, dst, multi_line=False)
    assert {r.video_id: r.description for r in again.collect()} == {
        "v1": 'x "q" y, z', "v2": VIDEO["description"],
    }


def test_repair_run_over_both_charsets(spark, tmp_path, rows):
    src, dst = tmp_path / "src" / "region=us", str(tmp_path / "dst")
    src.mkdir(parents=True)
    header = ",".join(schemas.BRONZE_STATISTICS_COLUMNS)

    def line(**over):
        return ",".join({**VIDEO, **over}[c] for c in schemas.BRONZE_STATISTICS_COLUMNS)

    old = [header, line(title="café"), line(video_id="v2", category_id="x"), line() + ",,"]
    (src / "old.csv").write_bytes("\n".join(old).encode("latin-1"))
    new = [header, line(video_id="v3", title='"a\nñ"')]
    (src / "new.csv").write_bytes("\n".join(new).encode("utf-8"))
    counts = run_csv_repair(spark, str(tmp_path / "src"), dst)
    assert rows(counts) == [("us", 3, 1, 1, 2)]
    clean = files.read_statistics_csv(spark, dst, multi_line=False)
    assert rows(clean, "video_id", "title") == [("v1", "café"), ("v3", "a ñ")]


PAYLOADS = ['{"a":1,"b":{"c":"x"}}', '{"a":2}', "not json", None, "[1,2]"]


def payload_frame(spark):
    return spark.createDataFrame(
        [(i, p, (1, ("y",))) for i, p in enumerate(PAYLOADS)],
        "id long, payload string, s struct<a:int,b:struct<c:string>>",
    )


def test_flatten_structs_and_json(spark, rows):
    df = payload_frame(spark)
    assert flatten.json_columns(df, ["payload"]) == ["payload"]
    flat = flatten.flatten(df, flatten.infer_json_schemas(df, ["payload"]))
    assert flat.columns == ["id", "payload_a", "payload_b_c", "payload_unparsed", "s_a", "s_b_c"]
    assert rows(flat, "id", "payload_a", "payload_b_c", "payload_unparsed", "s_b_c") == [
        (0, 1, "x", None, "y"), (1, 2, None, None, "y"), (2, None, None, "not json", "y"),
        (3, None, None, None, "y"), (4, None, None, "[1,2]", "y"),
    ]


def test_flatten_conflicting_types_arrays_and_clashes(spark):
    df = spark.createDataFrame(
        [('{"v":1,"l":[1],"n":null}',), ('{"v":{"x":1},"l":[2,3]}',)], "p string"
    )
    flat = flatten.flatten(df, flatten.infer_json_schemas(df, ["p"]))
    assert dict(flat.dtypes)["p_l"].startswith("array")
    got = flat.select("p_v", "p_l", "p_n").collect()
    assert sorted(r.p_v for r in got) == ["1", '{"x":1}']
    clash = spark.createDataFrame([(1, (2,))], "s_a int, s struct<a:int>")
    with pytest.raises(ValueError, match="s_a"):
        flatten.flatten(clash)
    prefixed = spark.createDataFrame([((2,),)], "s struct<s_id:int>")
    assert flatten.flatten(prefixed).columns == ["s_id"]


def test_flatten_with_pinned_schema_and_no_json(spark):
    df = payload_frame(spark)
    plain = spark.createDataFrame([("x",)], "t string")
    assert flatten.json_columns(plain, ["t"]) == []
    assert flatten.infer_json_schemas(plain, ["t"]) == {}
    from pyspark.sql import types as T

    pinned = {"payload": T.StructType([T.StructField("a", T.LongType())])}
    assert flatten.flatten(df, pinned).columns == ["id", "payload_a", "payload_unparsed", "s_a", "s_b_c"]


def test_default_survivors_do_not_depend_on_the_run(spark, rows):
    tied = [{"video_id": f"v{i % 20}", "title": f"T{i}", "views": "5"} for i in range(100)]
    kept = [
        rows(clean_statistics(csv_frame(spark, *order), job_name=job, as_of=F.lit(at).cast("timestamp")), "video_id", "title")
        for order, job, at in ((tied, "a", "2024-01-01"), (tied[::-1], "b", "2024-02-02"))
    ]
    assert kept[0] == kept[1] and len(kept[0]) == 20


def test_runs_in_which_nothing_survives(spark, tmp_path):
    report = run_bronze_to_silver([csv_frame(spark, {"video_id": None}, {"video_id": None})], job_name="j", path=str(tmp_path / "a"))
    assert (report.rows_read, report.rows_written, report.rows_removed) == (2, 0, 2)
    assert set(report.profile.values()) == {0}
    write_api_document(tmp_path / "api", "us", "2024-01-01", "00", [])
    empty = files.read_api_json(spark, str(tmp_path / "api"))
    assert run_bronze_to_silver([empty], job_name="j", path=str(tmp_path / "b")).rows_written == 0


def test_a_later_run_keeps_earlier_days_and_rows(spark, tmp_path, rows):
    path = str(tmp_path / "silver")
    first = csv_frame(spark, {"video_id": "v1"}, {"video_id": "v2"}, {"video_id": "v1", "region": "gb"})
    second = csv_frame(spark, {"video_id": "v1", "views": "9", "title": "new"}, {"video_id": "v3", "trending_date": "17.15.11"})
    for day_, frame_ in ((1, first), (2, second)):
        run_bronze_to_silver([frame_], job_name="j", path=path, as_of=F.lit(f"2024-01-0{day_}").cast("timestamp"))
    got = rows(spark.read.parquet(path), "region", "video_id", "title")
    assert got == [("gb", "v1", "T1"), ("us", "v1", "new"), ("us", "v2", "T1"), ("us", "v3", "T1")]


def test_an_over_long_category_is_dropped_and_counted(spark, tmp_path):
    from tidemark.sources import writers

    raw = tmp_path / "raw"
    writers.write_csv(csv_frame(spark, {"category_id": "9" * 20}, {"category_id": "7"}), str(raw))
    flagged = cleanse.flag_repairs(files.read_text_csv(spark, str(raw)))
    assert [r.category_id for r in cleanse.repaired(flagged).collect()] == [7]
    counts = cleanse.repair_counts(flagged).first()
    assert (counts.rows_before, counts.rows_dropped, counts.rows_after) == (2, 1, 1)


def test_regions_match_however_they_are_spelt(spark):
    df = csv_frame(spark, *[{"region": r} for r in ("US", "Us", " us", "us", "gb")])
    assert files.in_regions(df, ["us"]).count() == 4


def test_flatten_until_nothing_nested_remains(spark, tmp_path):
    import json

    from tidemark.plans.flat import run_flatten

    deep = json.dumps({"x": 1.5, "y": json.dumps({"z": [1, 2], "w": json.dumps({"q": "end", 'a"b?': {"c": True}})})})
    data = [
        (1, json.dumps({"a": json.dumps({"b": 1}), "n": {"m": None, "k": "text"}}), "plain", (7,)),
        (2, json.dumps({"a": deep, "t": {"k1": 1, "k2": "v"}}), "{", (8,)),
        (3, None, '  {"o": "{}"}', None),
        (4, "[1]", "x", (9,)),
        (5, '{"a":"not json"}', None, (9,)),
    ]
    df = spark.createDataFrame(data, "id int, j string, p string, s struct<v:int>")
    assert run_flatten(df, path=str(tmp_path / "flat"), maps=["j_t"])[:2] == ["id", "s_v"]
    got = {r.id: {k: v for k, v in r.asDict().items() if v is not None} for r in spark.read.parquet(str(tmp_path / "flat")).collect()}
    assert got[1] == {"id": 1, "j_n_k": "text", "p_unparsed": "plain", "j_a_b": 1, "s_v": 7}
    assert {k: str(v) for k, v in got[2].items()} == {
        "id": "2", "j_t": '{"k1":1,"k2":"v"}', "p_unparsed": "{", "j_a_x": "1.5", "j_a_y_z": "[1, 2]", "s_v": "8",
        "j_a_y_w_q": "end", 'j_a_y_w_a"b?_c': "True",
    }
    assert got[3] == {"id": 3, "p_o": "{}"}
    assert got[4] == {"id": 4, "j_unparsed": "[1]", "p_unparsed": "x", "s_v": 9}
    assert got[5] == {"id": 5, "j_a_unparsed": "not json", "s_v": 9}


def test_flatten_levels_parse_and_infer_once_each(spark, monkeypatch):
    import json

    parsed, seen = flatten.F.try_parse_json, []
    monkeypatch.setattr(flatten.F, "try_parse_json", lambda c: seen.append(c) or parsed(c))
    df = spark.createDataFrame([(json.dumps({"a": json.dumps({"b": json.dumps({"c": 1})})}),)], "j string")
    assert flatten.flatten_all(df).columns == ["j_unparsed", "j_a_unparsed", "j_a_b_c", "j_a_b_unparsed"]
    assert len(seen) == 3
    empty = flatten.flatten_all(spark.createDataFrame([], "id int, j string"))
    assert empty.columns == ["id", "j"] and empty.count() == 0


def test_keys_of_maps_take_no_part_in_inference(spark, monkeypatch):
    import json

    seen, fields = [], flatten._object_schema
    monkeypatch.setattr(flatten, "_object_schema", lambda ddl: seen.append(ddl) or fields(ddl))
    data = [(i, json.dumps({"a": {"n": i, "by": {f"k{i}": i}}, f"j_{i}": 1, "j_m": {f"m{i}": 1}})) for i in range(50)]
    data += [(50, json.dumps({"a": {"n": 50, "by": None}})), (51, json.dumps({"a": "text"})), (52, "none")]
    df = spark.createDataFrame([(i, j, json.dumps({f"p{i}": i})) for i, j in data], "id int, j string, p string")
    flat = flatten.flatten_all(df.filter("id < 51"), maps=["j_a_by", "j_m", "p"])
    assert [c for c in flat.columns if not c.removeprefix("j_").isdigit()] == ["id", "j_a_by", "j_a_n", "j_m", "j_unparsed", "p", "p_unparsed"]
    got = {r.id: r for r in flat.selectExpr("id", "j_a_n", "CAST(j_a_by AS STRING) by", "CAST(p AS STRING) p").collect()}
    assert got[7].j_a_n == 7 and got[7].by == '{"k7":7}' and got[7].p == '{"p7":7}'
    assert not any("k7" in ddl or "m7" in ddl or "p7" in ddl for ddl in seen if ddl)
    # A value that is an object in some rows only is text, which the next level parses.
    mixed = flatten.flatten_all(df.filter("id >= 50"), maps=["j_a_by"])
    assert mixed.columns == ["id", "j_unparsed", "p50", "p51", "p52", "p_unparsed", "j_a_by", "j_a_n", "j_a_unparsed"]
