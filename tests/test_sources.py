from __future__ import annotations

from pyspark.sql import functions as F

from samples import VIDEO
from tidemark import schemas
from tidemark.sources import catalog, files, writers

HEADER = ",".join(schemas.BRONZE_STATISTICS_COLUMNS)


def line(**over):
    v = {**VIDEO, **over}
    return ",".join(v[c] for c in schemas.BRONZE_STATISTICS_COLUMNS)


def put(base, region, *lines, encoding="utf-8", name="videos.csv"):
    folder = base / f"region={region}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes("\n".join([HEADER, *lines, ""]).encode(encoding))
    return str(base)


def test_quoted_csv_types_and_region(spark, tmp_path):
    put(tmp_path, "us", line(description='"a, ""b""\nc"'), line(video_id="v2"))
    path = put(tmp_path, "07", line(video_id="v3"))
    df = files.read_statistics_csv(spark, path)
    assert dict(df.dtypes)["views"] == "bigint" and dict(df.dtypes)["region"] == "string"
    got = {r.video_id: (r.description, r.region, r.views) for r in df.collect()}
    assert got == {
        "v1": ('a, "b"\nc', "us", 1000), "v2": ("d", "us", 1000), "v3": ("d", "07", 1000),
    }


def test_region_list_prunes_partitions(spark, tmp_path):
    put(tmp_path, "US", line())
    path = put(tmp_path, "gb", line())
    df = files.read_statistics_csv(spark, path, regions=["us"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "region#" in plan.split("PartitionFilters: [")[1][:40]
    assert [r.region for r in df.collect()] == ["US"]


def test_delimited_csv_with_backslash_escape(spark, tmp_path):
    path = put(tmp_path, "us", line(title=r"a\,b", description='say "x"'))
    row = files.read_delimited_csv(spark, path).first()
    assert (row.title, row.description) == ("a,b", 'say "x"')


def test_delimited_csv_with_any_characters(spark, tmp_path):
    odd = {
        "v1": "t\x02x\x01y", "v2": "", "v3": "ends with \\", "v4": ",\\,", "v5": "x" * 100_000 + ",\\" * 20_000,
    }
    escape = lambda t: t.replace("\\", "\\\\").replace(",", "\\,")
    lines = [line(video_id=v, description=escape(t), tags=escape(t)) for v, t in odd.items()]
    path = put(tmp_path, "us", *lines, "v6,short", "v7," + "," * 30, line(video_id="v8", description="lone\\"))
    got = {r.video_id: (r.description, r.tags) for r in files.read_delimited_csv(spark, path).collect()}
    short = {"v6": (None, None), "v7": ("", ""), "v8": ("lone\\", got["v8"][1])}
    assert got == {v: (t, t) for v, t in odd.items()} | short


def test_text_csv_keeps_empty_strings_and_splits_malformed(spark, tmp_path):
    short = ",".join(["v9", "17.14.11", "T"])
    long = line(video_id="v8", title='"a,b"') + ",extra"
    path = put(tmp_path, "us", line(tags="", description='""'), short, long)
    good, bad = files.split_malformed(files.read_text_csv(spark, path), 16)
    rows = {r.video_id: r for r in good.collect()}
    assert set(rows) == {"v1", "v9"}
    assert rows["v1"].tags == "" and rows["v1"].description == ""
    assert rows["v9"].category_id == ""
    assert [r._corrupt_record for r in bad.collect()] == [long]
    assert bad.count() == 1 and good.count() == 2


def test_field_count_ignores_quoted_separators(spark):
    df = spark.createDataFrame([('a,"b,c",d',), ('"x ""y"", z",1',), ("",)], "r string")
    assert [r[0] for r in df.select(files.field_count(F.col("r"))).collect()] == [3, 2, 1]


def test_charset_fallback_per_file(spark, tmp_path):
    put(tmp_path, "us", line(title="café"), encoding="latin-1", name="a.csv")
    path = put(tmp_path, "us", line(video_id="v2", title="中é"), name="b.csv")
    df = files.read_any_charset(
        spark, path, lambda p, enc: files.read_text_csv(spark, p, encoding=enc)
    )
    assert {r.video_id: r.title for r in df.collect()} == {"v1": "café", "v2": "中é"}
    flags = {r.is_utf8 for r in files.file_charsets(spark, path).collect()}
    assert flags == {True, False}


def test_all_utf8_is_read_once(spark, tmp_path):
    path = put(tmp_path, "us", line(title="é"))
    asked = []

    def read(p, encoding):
        asked.append(encoding)
        return files.read_text_csv(spark, p, encoding=encoding)

    assert files.read_any_charset(spark, path, read).first().title == "é"
    assert asked == [None]


def test_missing_input_is_none(spark, tmp_path):
    missing = files.read_if_present(
        lambda: files.read_statistics_csv(spark, str(tmp_path / "nothing"))
    )
    assert missing is None
    assert catalog.read_optional(spark, "no_such_table") is None


def test_table_scans(spark):
    df = spark.createDataFrame([("us", 1, "a"), ("gb", 2, "b")], "region string,n int,x string")
    df.createOrReplaceTempView("scan_me")
    narrow = catalog.read_table(spark, "scan_me", columns=["n"], regions=["US"])
    assert [tuple(r) for r in narrow.collect()] == [(1,)]
    assert catalog.read_table(spark, "scan_me", limit=1).count() == 1
    assert catalog.query_table(spark, "SELECT count(*) c FROM scan_me").first().c == 2


def test_partition_overwrite_is_idempotent_and_local(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("us", 1), ("gb", 2)], "region string,n int")
    writers.write_parquet(df, path, mode="overwrite")
    for _ in range(2):
        writers.write_parquet(df.filter("region='us'").withColumn("n", F.lit(9)), path)
    assert rows(spark.read.parquet(path), "region", "n") == [("gb", 2), ("us", 9)]
    writers.write_parquet(df.filter("region='us'"), path, mode="overwrite")
    assert rows(spark.read.parquet(path), "region", "n") == [("us", 1)]
    writers.write_parquet(df, path, mode="append")
    assert spark.read.parquet(path).count() == 3


def test_table_write_modes(spark, rows):
    writers.create_database(spark, "wdb")
    df = spark.createDataFrame([("us", 1), ("gb", 2)], "region string,n int")
    writers.write_table(df, "wdb.t")
    writers.write_table(df.filter("region='us'").withColumn("n", F.lit(9)), "wdb.t")
    assert rows(spark.table("wdb.t"), "region", "n") == [("gb", 2), ("us", 9)]
    writers.write_table(df.filter("region='us'"), "wdb.t", mode="append")
    assert spark.table("wdb.t").count() == 3
    writers.write_table(df.filter("region='us'"), "wdb.t", mode="overwrite")
    assert rows(spark.table("wdb.t"), "region", "n") == [("us", 1)]


def test_table_write_evolves_the_schema(spark, rows):
    writers.create_database(spark, "edb")
    writers.write_table(spark.createDataFrame([("us", 1)], "region string,n int"), "edb.t")
    newer = spark.createDataFrame([("gb", "x")], "region string,extra string")
    writers.write_table(newer, "edb.t")
    assert rows(spark.table("edb.t"), "region", "n", "extra") == [
        ("gb", None, "x"), ("us", 1, None),
    ]
    assert writers.evolve_table(spark, "edb.t", newer) == []


def test_rewrite_json_lines(spark, tmp_path, rows):
    folder = tmp_path / "in" / "region=us"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{\n "kind": "é",\n "nextPageToken": "x",\n "items": []\n}', "utf-8")
    (folder / "b.json").write_text('{"kind": ', "utf-8")
    bad = writers.rewrite_json_lines(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [r.region for r in bad.collect()] == ["us"]
    lines = spark.read.text(str(tmp_path / "out"))
    assert rows(lines, "value") == [('{"items":[],"kind":"é","nextPageToken":"x"}',)]


def test_register_table_over_files(spark, tmp_path):
    path = put(tmp_path, "us", line(), line(video_id="v2"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.BRONZE_STATISTICS)
    df = writers.register_table(
        spark, "bronze_stats", path, ddl=f"{ddl}, region STRING", fmt="csv",
        options={"header": "true", "quote": '"', "escape": '"'},
    )
    assert sorted(r.video_id for r in df.collect()) == ["v1", "v2"]
    again = writers.register_table(
        spark, "bronze_stats", path, ddl=f"{ddl}, region STRING", fmt="csv",
        options={"header": "true"},
    )
    assert again.filter("region = 'us'").count() == 2


def test_landing_documents(spark, tmp_path):
    documents = spark.createDataFrame(
        [(" US", [("v1",), ("v2",)]), ("gb", None)], "region string, items array<struct<id:string>>"
    )
    at = F.lit("2026-03-02 14:05:09").cast("timestamp")
    writers.land_videos(documents, str(tmp_path / "videos"), at, "api")
    df = files.read_api_json(spark, str(tmp_path / "videos"), multi_line=False)
    row = df.filter("region = 'us'").first()
    assert (row.date, row.hour) == ("2026-03-02", "14")
    assert row._pipeline_metadata.asDict() == {
        "ingestion_id": "20260302_140509", "region": "us", "video_count": 2, "source": "api",
        "ingestion_timestamp": "2026-03-02T14:05:09.000000+00:00",
    }
    assert df.filter("region = 'gb'").first()._pipeline_metadata.video_count == 0
    for _ in range(2):
        writers.land_reference(documents, str(tmp_path / "ref"), at, "api")
    assert spark.read.json(str(tmp_path / "ref")).count() == 2


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([("é", 1), ("b", 2)], "t string,n int")
    writers.write_json_lines(df.coalesce(1), str(tmp_path / "j"))
    texts = [p.read_text("utf-8") for p in (tmp_path / "j").glob("*.json")]
    assert sorted("".join(texts).split()) == ['{"t":"b","n":2}', '{"t":"é","n":1}']


def test_evolving_schemas(spark, tmp_path, rows):
    a = spark.createDataFrame([("us", 1)], "region string,n int")
    b = spark.createDataFrame([("gb", 2, "x")], "region string,n int,extra string")
    path = str(tmp_path / "e")
    writers.write_parquet(a, path)
    writers.write_parquet(b, path)
    expected = [("gb", 2, "x"), ("us", 1, None)]
    assert rows(writers.read_evolving(spark, path), "region", "n", "extra") == expected
    assert rows(writers.union_evolving(a, b), "region", "n", "extra") == expected


def test_named_partitions_are_pruned_by_their_stored_spelling(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("US", 1), (" us", 2), ("gb", 3), ("Secret", 4), (None, 5)], "region string, n int")
    writers.write_parquet(df, path)
    writers.create_database(spark, "named_parts")
    table = writers.register_table(
        spark, "named_parts.t", path, ddl="n INT, region STRING",
        partitions=[("US",), (" us",), ("gb",), ("not there yet",), (None,)],
    )
    assert rows(table, "n") == [(1,), (2,), (3,), (5,)]
    found = catalog.read_table(spark, "named_parts.t", regions=["Us", "secret"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [region#" in plan and " IN ( us,US)]" in plan and "InMemoryFileIndex(2 paths)" in plan
    assert rows(found, "n") == [(1,), (2,)]
    assert catalog.read_table(spark, "named_parts.t", regions=["nowhere"]).count() == 0


def test_rewrite_query_keeps_folders_and_files_few(spark, tmp_path, rows, monkeypatch):
    from tidemark.queries import ingest

    turns = spark.range(6000).selectExpr(
        "CAST(id DIV 2 AS BIGINT) AS conv_id", "id % 2 AS turn", "'user' AS role", "concat('\"conversations\" é ', id) AS text"
    )
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(ingest, "scratch_dir", lambda _, name: str(tmp_path / name))
    got = rows(ingest.json_rewrite(spark, str(tmp_path)))
    chars = {i: sum(len(f'"conversations" é {n}') for n in (2 * i, 2 * i + 1)) for i in range(3000)}
    assert got == sorted(
        ((i, True, None, None, None) if i % 7 == 3 else (i, False, 2, chars[i], i) for i in range(3000)), key=repr
    )
    assert len(list((tmp_path / "json-pretty").glob("shelf=*"))) <= 16
    assert len(list((tmp_path / "json-pretty").rglob("*.txt"))) == 12


def test_reference_query_keeps_regions_few(spark, tmp_path, rows, monkeypatch):
    from tidemark.queries import delivery

    suppliers = spark.range(13000).selectExpr("id AS s_suppkey", "concat('s', id) AS s_name")
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(delivery, "scratch_dir", lambda _, name: str(tmp_path / name))
    got = rows(delivery.reference_arrivals(spark, str(tmp_path)))
    want = [(None, None, r, "malformed JSON document") for r in range(1300) if r % 4 == 1]
    for i in range(13000):
        if i // 10 % 4 != 1 or i // 10 % 3 == 0:
            want.append((i, f"S{i}!" if i // 10 % 3 == 0 else f"s{i}", i // 10, None))
    assert got == sorted(want, key=repr)
    assert len(list((tmp_path / "documents").glob("region=*"))) == 24
