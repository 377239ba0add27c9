from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidetable.operators import (
    add_row_index,
    aggregate,
    bucket_aggregate,
    drop_null_columns,
    key_first,
    pivot_result,
    resample,
    shape_result,
    value_counts,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_index_follows_a_hot_key(spark):
    # Two thirds of the rows share one key, and some rows are equal in every column.
    df = spark.range(0, 30000).selectExpr("IF(id % 3 = 0, id, -1) AS k", "id % 50 AS v")
    out = add_row_index(df, "k").cache()
    assert out.columns == ["k", "v", "index"]
    assert out.agg(F.count("index"), F.countDistinct("index"), F.min("index"), F.max("index")).first()[:] == (30000, 30000, 0, 29999)
    bad = out.alias("a").join(out.alias("b"), F.expr("a.index + 1 = b.index")).where("a.k > b.k")
    assert bad.count() == 0
    assert out.groupBy("k", "v").count().exceptAll(df.groupBy("k", "v").count()).count() == 0


def test_row_index_spreads_the_hot_key(spark):
    df = spark.range(0, 30000).selectExpr("IF(id % 3 = 0, id, -1) AS k")
    keys = [F.col("k"), F.col("id2")]
    spread = df.withColumn("id2", F.monotonically_increasing_id()).repartitionByRange(8, *keys)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 30000 / 8


def test_row_index_orders(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "n int, s string").coalesce(1)
    assert sorted(map(tuple, add_row_index(df, F.col("n").desc(), "row").collect())) == [(1, "a", 2), (2, "b", 1), (3, "c", 0)]
    assert [tuple(r) for r in add_row_index(df).collect()] == [(2, "b", 0), (1, "a", 1), (3, "c", 2)]
    with pytest.raises(ValueError):
        add_row_index(df, "n", "s")
    assert add_row_index(df.where("n > 9"), "n").count() == 0


def test_aggregates(spark, events):
    out = aggregate(events, ["event_type"], {"n": ("count", "*"), "low": ("min", "value"), "high": ("max", "value"), "total": ("sum", "value"), "mean": ("avg", "value")})
    want = events.groupBy("event_type").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("value").alias("total"), F.avg("value").alias("mean"))
    assert out.count() == 5 and out.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        aggregate(events, [], {"m": ("median", "value")})


def test_bucket_aggregate(spark, events):
    out = bucket_aggregate(events, "day", {"n": ("count", "*")}, time_range=("2024-01-02", "2024-01-05"))
    rows = {r.time: r.n for r in out.collect()}
    assert sorted(rows) == [1704153600, 1704240000, 1704326400]
    assert sum(rows.values()) == events.where("time >= 1704153600 AND time < 1704412800").count()
    by_type = bucket_aggregate(events, "month", {"n": ("count", "*")}, by=["event_type"])
    assert by_type.columns == ["time", "event_type", "n"] and by_type.count() == 5


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "v string")
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("b", 2), ("a", 1), ("c", 1)]


def _seconds(*args):
    return int(dt.datetime(*args, tzinfo=dt.timezone.utc).timestamp())


def test_resample_fills_gaps(spark):
    rows = [(_seconds(2023, 11, 5), 3.0), (_seconds(2023, 11, 9), 4.0), (_seconds(2024, 2, 29), 1.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "time bigint, v double")
    out = resample(df, "month", {"high": ("max", "v"), "n": ("count", "v"), "total": ("sum", "v")}).orderBy("time").collect()
    assert [r.time for r in out] == [_seconds(2023, 11, 1), _seconds(2023, 12, 1), _seconds(2024, 1, 1), _seconds(2024, 2, 1)]
    assert [r.high for r in out] == [4.0, None, None, 1.0]
    assert [r.n for r in out] == [2, 0, 0, 1]
    assert [r.total for r in out] == [7.0, 0.0, 0.0, 1.0]
    ends = resample(df, "month", {"high": ("max", "v")}, label="end").orderBy("time")
    assert [r.time for r in ends.collect()][-1] == _seconds(2024, 2, 29)
    assert resample(df.where("v > 100"), "month", {"high": ("max", "v")}).count() == 0


@pytest.mark.parametrize("unit", ["minute", "hour", "day", "week", "month", "quarter", "year"])
def test_resample_steps_match_truncation(spark, events, unit):
    both = events.select("time", "value").unionByName(spark.createDataFrame([(-1000000, 1.0)], "time bigint, value double"))
    filled = resample(both, unit, {"n": ("count", "*")})
    grouped = bucket_aggregate(both, unit, {"n": ("count", "*")})
    if unit == "minute":
        assert filled.count() > 20_000_000 / 60
    assert filled.join(grouped, "time", "left_anti").where("n > 0").count() == 0
    assert grouped.join(filled, ["time", "n"], "left_anti").count() == 0


def test_resample_sizes_are_known(spark, events):
    df = resample(events, "day", {"high": ("max", "value")})
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" in text and "events.parquet" not in text and "Generate" not in text


def test_pivot_one_dimension(spark):
    rows = [(1, "x", 1.0), (1, "y", 2.0), (2, "x", 3.0), (2, None, 5.0)]
    df = spark.createDataFrame(rows, "time int, kind string, v double")
    out = pivot_result(df).orderBy("time")
    assert out.columns == ["time", "x", "y", "null"]
    assert [tuple(r) for r in out.collect()] == [(1, 1.0, 2.0, None), (2, 3.0, None, 5.0)]
    with pytest.raises(PySparkException, match="not among those listed"):
        pivot_result(df, ["y", "x"]).collect()
    given_values = pivot_result(df, ["y", "x"], other="drop").orderBy("time")
    assert given_values.columns == ["time", "y", "x"]
    assert [tuple(r) for r in given_values.collect()] == [(1, 2.0, 1.0), (2, None, 3.0)]


def test_pivot_more(spark):
    rows = [("a", 7, "p", 1.0, dt.datetime(2024, 1, 1)), ("a", 8, "p", 2.0, dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "day string, user_id int, kind string, v double, at timestamp_ntz")
    out = pivot_result(df)
    assert out.columns == ["day", "7_p_v", "7_p_at", "8_p_v", "8_p_at"]
    assert tuple(out.first()) == ("a", 1.0, dt.datetime(2024, 1, 1), 2.0, dt.datetime(2024, 1, 2))


def test_pivot_rules(spark):
    plain = spark.createDataFrame([("k", 1.0)], "key string, v double")
    assert pivot_result(plain) is plain
    with pytest.raises(ValueError):
        pivot_result(spark.createDataFrame([(1, "x")], "key int, kind string"))
    twice = spark.createDataFrame([(1, "x", 1.0), (1, "x", 1.0)], "key int, kind string, v double")
    with pytest.raises(PySparkException, match="duplicate"):
        pivot_result(twice).collect()
    stamped = spark.createDataFrame([(1, "x", dt.datetime(2024, 1, 1))] * 2, "key int, kind string, v timestamp_ntz")
    with pytest.raises(PySparkException, match="duplicate"):
        pivot_result(stamped).collect()
    alike = spark.createDataFrame([(1, "a_b", "c", 1.0), (1, "a", "b_c", 2.0)], "key int, p string, q string, v double")
    with pytest.raises(ValueError, match="a_b_c"):
        pivot_result(alike)
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        many = spark.range(4).selectExpr("1 AS key", "id AS x_id", "1.0D AS v")
        with pytest.raises(ValueError, match="more than 3"):
            pivot_result(many)
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


cells = st.dictionaries(
    st.tuples(st.integers(0, 4), st.sampled_from(["a", "b:1", "1:b", "", "é", "null"])),
    st.integers(-5, 5),
    min_size=1,
    max_size=12,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells)
def test_pivot_property(spark, data):
    df = spark.createDataFrame([(k, d, v) for (k, d), v in data.items()], "key int, kind string, v int")
    out = pivot_result(df)
    got = {(r["key"], c): r[c] for r in out.collect() for c in out.columns[1:] if r[c] is not None}
    assert got == data


def test_drop_null_columns(spark):
    df = spark.range(5000).selectExpr(
        "id", "CAST(NULL AS STRING) AS t", "CAST('NaN' AS DOUBLE) AS f", "IF(id = 4999, 1, NULL) AS late",
        "NULL AS v", "IF(id = 0, 'x', NULL) AS early",
    )
    assert drop_null_columns(df).columns == ["id", "late", "early"]
    assert drop_null_columns(df.where("id < 0")).columns == []


def test_key_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert key_first(df, "c").columns == ["c", "a", "b"]
    assert key_first(df, ["b", "c"]).columns == ["b", "c", "a"]
    with pytest.raises(ValueError):
        key_first(df, "d")


def test_shape_result(spark):
    df = spark.createDataFrame([("x", 1262304000, 1.0, math.nan)], "kind string, time bigint, v double, e double")
    out = shape_result(df, dropna=True, timezone="Asia/Tokyo")
    assert out.columns == ["time", "kind", "v"]
    assert out.select(F.col("time").cast("string")).first()[0] == "2010-01-01 09:00:00"
    wide = shape_result(df.select("time", "kind", "v"), pivot=True)
    assert wide.columns == ["time", "x"]
