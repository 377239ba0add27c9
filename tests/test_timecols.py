from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidetable.operators import build_time, convert_time, format_dates, parse_dates, shift_timezone


def ntz(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def test_time_from_datetime_floors(spark):
    rows = [(dt.datetime(1969, 12, 31, 23, 59, 59, 500000),), (dt.datetime(2010, 1, 1, 0, 0, 0, 999999),), (None,)]
    df = build_time(spark.createDataFrame(rows, "at timestamp_ntz"), "at")
    assert df.columns == ["time"]
    assert [r.time for r in df.collect()] == [-1, 1262304000, None]


def test_time_from_text_and_numbers(spark):
    df = spark.createDataFrame([("2010-01-01 00:00:01", 7, 7.9, dt.date(2010, 1, 1))], "a string, b int, c double, d date")
    assert build_time(df, "a").first().time == 1262304001
    assert build_time(df, "b").first().time == 7
    assert build_time(df, "c").first().time == 7
    assert build_time(df, "d").first().time == 1262304000
    other = spark.createDataFrame([("01/02/2010",)], "a string")
    assert build_time(other, "a", time_format="%d/%m/%Y").first().time == 1264982400


def test_time_from_key_column(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 1, 1), "x")], "at timestamp_ntz, k string")
    out = build_time(df, time_key="at")
    assert out.columns == ["at", "k", "time"] and out.first().time == 1262304000
    with pytest.raises(TypeError):
        build_time(df, time_key="k")


def test_time_default_is_one_constant(spark):
    out = build_time(spark.range(1000))
    assert out.select("time").distinct().count() == 1
    assert build_time(spark.range(1), now=5).first().time == 5


def test_time_rules(spark):
    df = spark.createDataFrame([(1, 2)], "time int, other int")
    with pytest.raises(ValueError):
        build_time(df)
    with pytest.raises(ValueError):
        build_time(df, "other")
    with pytest.raises(ValueError):
        build_time(df, "time", "other")
    assert build_time(df, "time").first().time == 1


def test_bad_text_raises_or_is_kept(spark):
    df = spark.createDataFrame([("soon",)], "a string")
    with pytest.raises(PySparkException):
        build_time(df, "a").collect()
    assert build_time(df, "a", lenient=True).first().asDict() == {"time": None, "_time_text": "soon"}


def test_format_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 1, 2, 3, 4, 5), dt.date(2011, 1, 1), 5)], "a timestamp_ntz, b date, time bigint")
    assert tuple(format_dates(df, "%d.%m.%y").first()) == ("02.01.10", "01.01.11", 5)
    assert format_dates(df, None) is df


def test_parse_dates(spark):
    seconds = 1709218799
    df = spark.createDataFrame(
        [("2024-02-29 14:59:59", "29/02/2024", 19782, seconds, seconds * 1000 + 1, seconds * 10**6 + 7, seconds * 10**9 + 123456999)],
        "a string, b string, d bigint, s bigint, ms bigint, us bigint, ns bigint",
    )
    when = dt.datetime(2024, 2, 29, 14, 59, 59)
    assert ntz(parse_dates(df, ["a"])).first().a == when
    out = ntz(parse_dates(df, {"b": "%d/%m/%Y", "d": "D", "s": "s", "ms": "ms", "us": "us", "ns": "ns"})).first()
    assert out.b == dt.datetime(2024, 2, 29) == out.d
    assert out.s == when
    assert out.ms == when.replace(microsecond=1000)
    assert out.us == when.replace(microsecond=7)
    assert out.ns == when.replace(microsecond=123456)
    before = spark.createDataFrame([(-1,)], "ns bigint")
    assert ntz(parse_dates(before, {"ns": "ns"})).first().ns == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
    with pytest.raises(ValueError):
        parse_dates(df, {"s": "weeks"})
    with pytest.raises(PySparkException):
        parse_dates(df, {"a": "%d/%m/%Y"}).collect()


def test_convert_time(spark):
    when = dt.datetime(2010, 1, 1)
    for df in (
        spark.createDataFrame([(1262304000,)], "time bigint"),
        spark.createDataFrame([("2010-01-01 00:00:00",)], "time string"),
        spark.createDataFrame([(when,)], "time timestamp_ntz"),
    ):
        out = convert_time(df)
        assert out.schema["time"].dataType.simpleString() == "timestamp"
        assert ntz(out).first().time == when
    plain = spark.range(1)
    assert convert_time(plain) is plain


def test_shift_timezone(spark):
    df = convert_time(spark.createDataFrame([(1262304000,)], "time bigint"))
    assert ntz(shift_timezone(df, "Asia/Tokyo")).first().time == dt.datetime(2010, 1, 1, 9)
    with pytest.raises(ValueError):
        shift_timezone(df, "Nowhere/Town")
