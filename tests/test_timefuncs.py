from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidetable.functions import (
    epoch_format,
    epoch_trunc,
    in_time_range,
    parse_pattern,
    register_time_functions,
    strftime,
    to_epoch,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("value", "seconds"),
    [
        (None, None),
        (1262304000, 1262304000),
        (-5, -5),
        ("2010", 1262304000),
        ("2010-01-01", 1262304000),
        ("2010-01-01 00:00:00", 1262304000),
        ("2010-01-01 00:00:00.999999", 1262304000),
        ("2010-01-01 00:00:00+09:00", 1262304000 - 9 * 3600),
        (dt.date(2010, 1, 1), 1262304000),
        (dt.datetime(2010, 1, 1, 0, 0, 0, 5), 1262304000),
        (dt.datetime(2010, 1, 1, 9, tzinfo=dt.timezone(dt.timedelta(hours=9))), 1262304000),
        ("1969-12-31 23:59:59.5", -1),
    ],
)
def test_bounds(value, seconds):
    assert to_epoch(value) == seconds


@pytest.mark.parametrize("value", [1.5, True, [1], "NaT"])
def test_bad_bounds(value):
    with pytest.raises(ValueError):
        to_epoch(value)


def test_range_is_half_open(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "time")
    got = [r.time for r in df.where(in_time_range(F.col("time"), 3, 6)).collect()]
    assert got == [3, 4, 5]
    assert df.where(in_time_range(F.col("time"), None, 2)).count() == 2
    assert df.where(in_time_range(F.col("time"), 8)).count() == 2
    assert df.where(in_time_range(F.col("time"))).count() == 10


def test_range_reaches_the_scan(spark, events, tmp_path):
    path = str(tmp_path / "e")
    events.write.parquet(path)
    stored = spark.read.parquet(path)
    by_column = stored.where(in_time_range(F.col("time"), "2024-01-01", "2024-01-10"))
    by_sql = stored.where("time_range(time, '2024-01-01', '2024-01-10')")
    for df in (by_column, by_sql):
        text = plan(df)
        assert "GreaterThanOrEqual(time,1704067200)" in text
        assert "LessThan(time,1704844800)" in text
    assert by_column.count() == by_sql.count() > 0
    assert stored.where("time_range(time, NULL, '2024-01-10')").count() == stored.where("time < 1704844800").count()


def test_trunc_units(spark):
    when = 1709218799  # Thu 2024-02-29 14:59:59 UTC
    df = spark.createDataFrame([(when,), (-1,)], "time bigint")
    expected = {
        "second": when,
        "minute": 1709218740,
        "hour": 1709215200,
        "day": 1709164800,
        "week": 1708905600,
        "month": 1706745600,
        "quarter": 1704067200,
        "year": 1704067200,
    }
    row = df.select(*[epoch_trunc(u, F.col("time")).alias(u) for u in expected]).collect()
    assert row[0].asDict() == expected
    assert row[1].day == -86400 and row[1].year == -31536000
    for unit, value in expected.items():
        assert df.limit(1).selectExpr(f"epoch_trunc('{unit}', time) v").first().v == value


def test_trunc_in_a_zone(spark):
    df = spark.createDataFrame([(1709218799,)], "time bigint")
    tokyo = df.select(epoch_trunc("day", F.col("time"), "Asia/Tokyo").alias("v")).first().v
    assert tokyo == 1709132400  # 2024-02-28 15:00 UTC is midnight of the 29th there
    assert df.selectExpr("epoch_trunc_in('day', time, 'Asia/Tokyo') v").first().v == tokyo
    with pytest.raises(ValueError):
        epoch_trunc("day", F.col("time"), "Mars/Base")
    with pytest.raises(ValueError):
        epoch_trunc("fortnight", F.col("time"))


def test_format_with_literal(spark):
    df = spark.createDataFrame([(1709218799,)], "time bigint")
    assert df.select(epoch_format(F.col("time"), "yyyy-01-01").alias("v")).first().v == "2024-01-01"
    assert df.selectExpr("epoch_format(time, 'yyyy-MM') v").first().v == "2024-02"
    assert df.selectExpr("epoch_format_in(time, 'HH', 'Asia/Tokyo') v").first().v == "23"


def test_functions_in_a_database_serve_every_session(spark, db):
    register_time_functions(spark, db)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    got = other.sql(f"SELECT count(*) n FROM VALUES (1262303999L), (1262304000L) AS t(time) WHERE {db}.time_range(time, '2010', NULL)")
    assert got.first().n == 1


FORMATS = [
    "%Y-%m-%d %H:%M:%S",
    "%Y%m%d",
    "%d/%b/%Y:%H:%M:%S",
    "%y %j",
    "%I:%M %p",
    "%A %B",
    "%a o'clock",
    "%F %T",
    "%s",
    "%w%u",
    "%V %G",
    "%U/%W",
    "100%% %f",
    "plain",
]


@pytest.mark.parametrize("fmt", FORMATS)
def test_strftime_like_python(spark, fmt):
    stamps = [dt.datetime(2024, 2, 29, 14, 5, 9, 12), dt.datetime(2021, 1, 3), dt.datetime(1999, 12, 31, 23, 59, 59)]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    got = [r.v for r in df.select(strftime(F.col("t").cast("timestamp"), fmt).alias("v")).collect()]
    utc = [t.replace(tzinfo=dt.timezone.utc) for t in stamps]
    assert got == [t.strftime(fmt) for t in utc]


@pytest.mark.parametrize(
    ("text", "fmt"),
    [
        ("2024-02-29 14:05:09", "%Y-%m-%d %H:%M:%S"),
        ("20240229140509", "%Y%m%d%H%M%S"),
        ("2/9/2024 4:05:09", "%m/%d/%Y %H:%M:%S"),
        ("29/Feb/2024", "%d/%b/%Y"),
        ("02:05 PM 2024-02-29", "%I:%M %p %Y-%m-%d"),
        ("2024-02-29T14:05:09.25", "%Y-%m-%dT%H:%M:%S.%f"),
        ("2024060", "%Y%j"),
    ],
)
def test_parse_like_python(spark, text, fmt):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.to_timestamp("t", parse_pattern(fmt)).cast("timestamp_ntz").alias("v")).first().v
    assert got == dt.datetime.strptime(text, fmt)


def test_unsupported_directives():
    for fmt in ("%Q", "%"):
        with pytest.raises(ValueError):
            parse_pattern(fmt)
    with pytest.raises(ValueError):
        strftime(F.col("t"), "%Q")
