from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidetable import (
    ResultNotReadyError,
    iter_rows,
    list_databases,
    list_tables,
    load_table,
    read_result,
    read_table,
    run_query,
    save_result,
)
from tidetable.sources import bind_placeholders

from conftest import DATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def loaded(spark, db, events):
    load_table(events, f"{db}.events")
    return f"{db}.events"


def test_read_table(spark, loaded, events):
    assert read_table(spark, loaded, limit=None).count() == events.count()
    assert read_table(spark, loaded, limit=3).count() == 3
    some = read_table(spark, loaded, ["event_id", "value * 2 AS twice"], ("2024-01-02", 1704326400), None, index_col="twice")
    assert some.columns == ["twice", "event_id"]
    assert some.count() == events.where("time >= 1704153600 AND time < 1704326400").count()
    text = plan(some)
    assert "ReadSchema: struct<event_id:bigint,value:double,time:bigint>" in text
    assert "GreaterThanOrEqual(time,1704153600), LessThan(time,1704326400)" in text
    first = read_table(spark, loaded, ["event_id"], limit=5, order_by=F.col("event_id").desc())
    top = events.agg(F.max("event_id")).first()[0]
    assert [r.event_id for r in first.collect()] == [top - i for i in range(5)]
    assert "TakeOrderedAndProject" in plan(first)
    parsed = read_table(spark, loaded, parse={"time": "s"})
    assert parsed.schema["time"].dataType.simpleString() == "timestamp"


def test_all_rows_unless_limited(spark, db):
    load_table(spark.range(25_000), f"{db}.big")
    assert read_table(spark, f"{db}.big").count() == 25_000
    assert read_table(spark, f"{db}.big", limit=10).count() == 10


def test_run_query(spark, loaded, events, db, tmp_path):
    text = "SELECT count(*) AS n FROM events WHERE time_range(time, '{start}', {end}) AND event_type IN ({kind}, 'x')"
    assert bind_placeholders(text).endswith("time_range(time, :start, :end) AND event_type IN (:kind, 'x')")
    params = {"start": "2024-01-02", "end": None, "kind": "click"}
    got = run_query(spark, text, params, db=db)
    assert got.first().n == events.where("time >= 1704153600 AND event_type = 'click'").count()
    assert spark.catalog.currentDatabase() != db
    named = run_query(spark, "SELECT max(value) AS top FROM IDENTIFIER({t})", {"t": loaded})
    assert named.first().top == events.agg(F.max("value")).first()[0]
    run_query(spark, "SELECT 1 AS a, 'x' AS b", result_url=str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).collect()[0].asDict() == {"a": "1", "b": "x"}
    keyed = run_query(spark, "SELECT 1 AS a, '2024-01-01' AS d", index_col="d", parse=["d"])
    assert keyed.columns == ["d", "a"] and keyed.schema["d"].dataType.simpleString() == "timestamp"
    with pytest.raises(ValueError, match="unknown option"):
        run_query(spark, "SELECT 1", type="hive")
    assert run_query(spark, f"CREATE TABLE {db}.made (a INT) USING parquet").columns == []


def test_quoted_value_is_bound_not_spliced(spark):
    got = run_query(spark, "SELECT '{x}' AS x", {"x": "a' OR '1'='1"})
    assert got.first().x == "a' OR '1'='1"


def test_join_strategy(spark):
    text = f"SELECT c_mktsegment, o_totalprice FROM parquet.`{DATA}/orders.parquet` JOIN parquet.`{DATA}/customer.parquet` ON o_custkey = c_custkey"
    wide = run_query(spark, text, join="broadcast")
    split = run_query(spark, text, join="partitioned")
    assert "BroadcastHashJoin" in plan(wide)
    assert "SortMergeJoin" in plan(split)
    assert wide.exceptAll(split).count() == 0 and wide.count() == split.count()
    # The setting stays with the query.
    assert "BroadcastHashJoin" in plan(run_query(spark, text))
    with pytest.raises(ValueError):
        run_query(spark, text, join="hash")


def test_broadcast_is_bounded(spark):
    from tidetable.sources.queries import join_settings
    from tidetable.session import isolated_session

    session = isolated_session(spark, join_settings("broadcast", broadcast_limit=10))
    df = session.sql(f"SELECT 1 FROM parquet.`{DATA}/orders.parquet` JOIN parquet.`{DATA}/customer.parquet` ON o_custkey = c_custkey")
    assert "SortMergeJoin" in plan(df)


def test_stored_results(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "2024-01-01", [1.5])], "a int, d string, x array<double>")
    save_result(df, 42, root)
    back = read_result(spark, 42, root)
    assert back.schema == df.schema and back.collect() == df.collect()
    assert read_result(spark, 42, root, index_col="d", parse=["d"]).first()[0] == dt.datetime(2024, 1, 1)
    with pytest.raises(PySparkException):
        save_result(df, 42, root)
    with pytest.raises(ResultNotReadyError):
        read_result(spark, 43, root)
    (tmp_path / "results" / "44").mkdir()
    with pytest.raises(ResultNotReadyError):
        read_result(spark, 44, root, wait_seconds=0.1)
    with pytest.raises(ValueError):
        read_result(spark, "../42", root)
    save_result(df, "in-shared")
    assert read_result(spark, "in-shared").count() == 1


def test_iter_rows(spark):
    df = spark.range(100, numPartitions=5).selectExpr("id", "id * 2 AS twice")
    rows = list(iter_rows(df))
    assert rows == [(i, {"id": i, "twice": 2 * i}) for i in range(100)]
    assert next(iter_rows(df, prefetch=False)) == (0, {"id": 0, "twice": 0})
    assert list(iter_rows(df.where("id < 0"))) == []


def test_inventory(spark, loaded, db, events):
    spark.sql(f"CREATE TABLE {db}.bare (a INT) USING parquet")
    load_table(spark.createDataFrame([(1, 5)], "a int, time int"), f"{db}.s", load_id="x")
    load_table(spark.createDataFrame([(1, 9)], "a int, time int"), f"{db}.s", "append", load_id="y")
    rows = {r.name: r for r in list_tables(spark, f"^{db}").collect()}
    assert set(rows) == {"events", "bare", "s"}
    assert rows["events"]["count"] == events.count() and rows["bare"]["count"] == 0 and rows["s"]["count"] == 2
    assert rows["events"].estimated_storage_size > 1000 and rows["s"].estimated_storage_size > 100
    last = events.agg(F.max("time")).first()[0]
    assert rows["events"].last_log_timestamp == dt.datetime.fromtimestamp(last, dt.timezone.utc).replace(tzinfo=None)
    assert rows["bare"].last_log_timestamp is None
    assert abs((rows["bare"].created_at - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 600
    assert [r.name for r in list_tables(spark, "events$", db).collect()] == ["events"]
    found = list_databases(spark, db).collect()
    assert [(r.name, r["count"]) for r in found] == [(db, events.count() + 2)]
    assert list_databases(spark, "no such name").count() == 0
    assert list_tables(spark, "no such name").count() == 0
