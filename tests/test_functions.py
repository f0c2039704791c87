from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import casts, dates, metrics, text


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    return df.select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("  a b \t", "a b"), (" x ", "x"), ("\x1cx\x1f", "x"), ("", ""), (None, None),
        ("a​", "a​"),
    ],
)
def test_strip_whitespace_matches_python_strip(spark, given, expected):
    assert one(spark, given, text.strip_whitespace) == expected
    assert expected is None or given.strip() == expected


@pytest.mark.parametrize(
    "given, expected", [("a\r\n\r\nb\nc", "a b c"), ("\nx\n", "x"), ("plain", "plain")]
)
def test_tidy_text(spark, given, expected):
    assert one(spark, given, text.tidy_text) == expected


def test_normalize_region(spark):
    assert one(spark, " US\t", text.normalize_region) == "us"


@pytest.mark.parametrize(
    "given, expected",
    [
        ("a/region=us/x.json", "us"), ("region=gb/date=1", "gb"), ("a/b.json", "unknown"),
        ("a/region=us/region=gb/x", "us"), ("a/myregion=us/x", "unknown"),
    ],
)
def test_region_from_path(spark, given, expected):
    assert one(spark, given, text.region_from_path) == expected


def test_decode_key(spark):
    assert one(spark, "a%20b+c%C3%A9", text.decode_key) == "a b cé"
    assert one(spark, "100%zz", text.decode_key) == "100%zz"
    assert one(spark, "a+b%20c", text.decode_file_path) == "a+b c"


def test_decode_bytes(spark):
    assert one(spark, "é".encode("latin-1"), text.decode_bytes, "binary") == "é"
    assert one(spark, "é€".encode(), text.decode_bytes, "binary") == "é€"


def test_minify_json(spark):
    assert one(spark, '{\n "a": "é",\n "b": [1, 2]\n}', text.minify_json) == '{"a":"é","b":[1,2]}'
    assert one(spark, "{bad", text.minify_json) is None


def test_item_count(spark):
    assert one(spark, ["a", "b"], text.item_count, "array<string>") == 2
    assert one(spark, None, text.item_count, "array<string>") == 0


@pytest.mark.parametrize(
    "given, expected",
    [
        ("12", 12), ("12.7", 12), ("-12.7", -12), ("abc", None), ("", None), (None, None),
        ("9007199254740993", 9007199254740993), (" 5 ", 5), ("1e3", 1000),
        ("99999999999999999999", None),
    ],
)
def test_to_long(spark, given, expected):
    assert one(spark, given, casts.to_long) == expected


@pytest.mark.parametrize(
    "given, loose, strict",
    [
        ("TRUE", True, True), ("false", False, False), ("", None, None), ("yes", True, None),
        ("0", False, None), (None, None, None),
    ],
)
def test_flags(spark, given, loose, strict):
    assert one(spark, given, casts.to_flag) is loose
    assert one(spark, given, casts.text_flag) is strict


@pytest.mark.parametrize(
    "given, expected",
    [
        ("17.14.11", dt.date(2017, 11, 14)), ("2017-11-14", dt.date(2017, 11, 14)),
        ("17.31.02", None), ("zzz", None), (None, None), ("", None),
    ],
)
def test_parse_trending_date(spark, given, expected):
    assert one(spark, given, dates.parse_trending_date) == expected


def test_stamps(spark):
    at = dt.datetime(2026, 3, 2, 14, 5, 9)
    stamps = [
        one(spark, at, fn, "timestamp_ntz")
        for fn in (dates.trending_stamp, dates.day_stamp, dates.hour_stamp,
                   dates.ingestion_id, dates.iso_stamp)
    ]
    assert stamps == [
        "26.02.03", "2026-03-02", "14", "20260302_140509", "2026-03-02T14:05:09.000000+00:00",
    ]


def test_hours_before(spark):
    at = dt.datetime(2026, 3, 2, 14)
    earlier = one(spark, at, lambda c: dates.hours_before(c, 48), "timestamp_ntz")
    assert earlier == dt.datetime(2026, 2, 28, 14)


@pytest.mark.parametrize(
    "likes, dislikes, comments, views, ratio, rate",
    [(1, 1, 0, 3, 33.3333, 66.6667), (5, 0, 0, 0, 0.0, 0.0), (5, 1, 1, -1, 0.0, 0.0)],
)
def test_ratios(spark, likes, dislikes, comments, views, ratio, rate):
    df = spark.createDataFrame([(likes, dislikes, comments, views)], "l long,d long,c long,v long")
    got = df.select(
        metrics.like_ratio(F.col("l"), F.col("v")),
        metrics.engagement_rate(F.col("l"), F.col("d"), F.col("c"), F.col("v")),
    ).first()
    assert tuple(got) == (ratio, rate)


def test_average_ratio_does_not_depend_on_order(spark):
    values = [0.1, 33.3333, 0.0001, 1e6, 66.6667] * 200
    df = spark.createDataFrame([(v,) for v in values], "x double")
    total = F.sum(metrics.ratio_units(F.col("x")))
    averages = {
        df.repartition(n).agg(metrics.average_ratio(total, F.count("x"))).first()[0]
        for n in (1, 3, 7)
    }
    assert averages == {(0.1 + 33.3333 + 0.0001 + 1e6 + 66.6667) / 5}


def test_percent_of_nothing_is_null(spark):
    assert one(spark, 0, lambda c: metrics.percent(F.lit(1), c, 2), "long") is None
