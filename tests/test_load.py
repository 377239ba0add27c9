from __future__ import annotations

import datetime as dt
import math
import time

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidetable import (
    LoadError,
    NoValidRecordsError,
    TableExistsError,
    create_table,
    load_table,
    read_table,
    recast_columns,
    store_frame,
    write_csv,
)
from tidetable.operators import declared_schema
from tidetable.sinks import Destination, drop_table, loads_of, rows_per_file
from tidetable.sinks.snapshots import GRACE_SETTING, current, store_of, sweep
from tidetable.sinks.storage import child_names, path_exists


def table(spark, name):
    return sorted((tuple(r) for r in read_table(spark, name, limit=None).collect()), key=lambda t: [(v is None, v) for v in t])


def runs(dest):
    """Folders of files that the table's store holds."""
    return len(child_names(dest.spark, f"{store_of(dest)}/runs"))


def two(spark, *values):
    return spark.createDataFrame([(v, 1) for v in values], "a int, time int")


def test_create_and_read(spark, db):
    df = spark.createDataFrame([(1, "x", True)], "`Some ID` int, B string, c boolean")
    before = int(time.time())
    report = load_table(df, f"{db}.t")
    assert (report.total, report.valid, report.rejected, report.skipped) == (1, 1, 0, False)
    stored = spark.table(f"{db}.t")
    assert dict(stored.dtypes) == {"some_id": "bigint", "b": "string", "c": "string", "time": "bigint"}
    row = stored.first()
    assert row.c == "true" and before <= row.time <= time.time()


@pytest.mark.parametrize("extra", [{}, {"validate": True}])
def test_if_exists(spark, db, extra):
    name = f"{db}.t"
    load_table(two(spark, 1, 2), name, "append", **extra)
    for word in ("error", "fail"):
        with pytest.raises(TableExistsError):
            load_table(two(spark, 3), name, word, **extra)
    assert load_table(two(spark, 3), name, "ignore", **extra).skipped
    assert table(spark, name) == [(1, 1), (2, 1)]
    load_table(two(spark, 3), name, "append", **extra)
    assert table(spark, name) == [(1, 1), (2, 1), (3, 1)]
    for word in ("overwrite", "replace"):
        load_table(spark.createDataFrame([("z", 5.0, 2)], "q string, r float, time int"), name, word, **extra)
        assert dict(read_table(spark, name).dtypes) == {"q": "string", "r": "double", "time": "bigint"}
        assert table(spark, name) == [("z", 5.0, 2)]
    if not extra:
        dest = Destination.of(spark, name)
        spark.conf.set(GRACE_SETTING, "0")
        sweep(dest)
        spark.conf.unset(GRACE_SETTING)
        assert {t.name for t in spark.catalog.listTables(db)} == {"t", current(dest).data}


def test_if_exists_is_checked_first(spark, db):
    with pytest.raises(ValueError):
        load_table(two(spark, 1), f"{db}.t", "bar")
    assert not spark.catalog.tableExists(f"{db}.t")
    with pytest.raises(ValueError):
        load_table(two(spark, 1), "no_such_db.t")
    with pytest.raises(ValueError):
        load_table(two(spark, 1), "a.b.c")


def test_current_database(spark, db):
    spark.catalog.setCurrentDatabase(db)
    load_table(two(spark, 1), "here")
    assert spark.catalog.tableExists(f"{db}.here")


def test_pandas_input(spark, db):
    frame = pd.DataFrame([[1, 2], [3, 4]])
    load_table(frame, f"{db}.p", spark=spark)
    got = spark.table(f"{db}.p")
    assert got.columns == ["0", "1", "time"]
    assert sorted(r[0] for r in got.collect()) == [1, 3]
    assert list(frame.columns) == [0, 1]
    indexed = pd.DataFrame({"v": [1.0, None]}, index=pd.Index(["x", "y"], name="Key"))
    store_frame(indexed, f"{db}.q", spark=spark, index=True)
    assert sorted((r.v or 0, r.key) for r in spark.table(f"{db}.q").collect()) == [(0, "y"), (1.0, "x")]
    many = pd.DataFrame({"v": [1, 2]}, index=pd.MultiIndex.from_tuples([("a", 1), ("b", 2)], names=["k", None]))
    store_frame(many, f"{db}.r", spark=spark, index=True)
    assert spark.table(f"{db}.r").columns == ["v", "k", "level_1", "time"]


def test_nulls_and_special_floats(spark, db):
    frame = pd.DataFrame({"f": [1.0, math.nan, math.inf, -math.inf, 2.5], "i": [1, 2, 3, 4, 5], "s": list("abcd") + [None]})
    load_table(frame, f"{db}.w", spark=spark)
    rows = {r.i: (r.f, r.s) for r in spark.table(f"{db}.w").collect()}
    assert rows == {1: (1.0, "a"), 2: (None, "b"), 3: (math.inf, "c"), 4: (-math.inf, "d"), 5: (2.5, None)}


def test_append_by_name(spark, db):
    name = f"{db}.t"
    load_table(spark.createDataFrame([(1, "x", 1)], "a int, b string, time int"), name)
    load_table(spark.createDataFrame([(2, 9)], "time int, a int"), name, "append")
    assert set(table(spark, name)) == {(1, "x", 1), (9, None, 2)}
    more = spark.createDataFrame([(3, 3, 1.5)], "a int, time int, c double")
    with pytest.raises(PySparkException):
        load_table(more, name, "append")
    load_table(more, name, "append", evolve=True)
    assert set(table(spark, name)) == {(1, "x", 1, None), (9, None, 2, None), (3, None, 3, 1.5)}


def test_overwrite_a_table_being_read(spark, db):
    name = f"{db}.t"
    load_table(two(spark, 1, 2, 3), name)
    load_table(spark.table(name).where("a > 1"), name, "overwrite")
    assert table(spark, name) == [(2, 1), (3, 1)]
    load_table(spark.table(name).withColumn("a", F.col("a") * 10), name, "overwrite", validate=True)
    assert table(spark, name) == [(20, 1), (30, 1)]
    load_table(read_table(spark, name).where("a > 20"), name, "overwrite", validate=True)
    assert table(spark, name) == [(30, 1)]
    load_table(read_table(spark, name), name, "append")
    assert table(spark, name) == [(30, 1), (30, 1)]


def test_empty_input(spark, db):
    empty = two(spark, 1).where("a > 1")
    for extra in ({}, {"validate": True}):
        with pytest.raises(NoValidRecordsError):
            load_table(empty, f"{db}.t", **extra)
        assert not spark.catalog.tableExists(f"{db}.t")
    load_table(two(spark, 1), f"{db}.t")
    for mode in ("overwrite", "append"):
        with pytest.raises(LoadError):
            load_table(empty, f"{db}.t", mode)
        assert table(spark, f"{db}.t") == [(1, 1)]


def test_failed_overwrite_keeps_the_table(spark, db):
    name = f"{db}.t"
    load_table(two(spark, 1), name)
    broken = two(spark, 2).withColumn("a", F.expr("IF(a = 2, raise_error('no'), a)").cast("int"))
    for extra in ({}, {"validate": True}):
        with pytest.raises(PySparkException):
            load_table(broken, name, "overwrite", **extra)
        assert table(spark, name) == [(1, 1)]


def test_validated_load(spark, db, caplog):
    name = f"{db}.v"
    rows = [("1", "2024-01-01 00:00:00", "ok"), ("x", "2024-01-01 00:00:01", "bad a"), ("3", "soon", "bad time"), (None, None, "no time"), (None, "2024-01-02", "null a")]
    df = spark.createDataFrame(rows, "a string, time string, note string")
    schema = declared_schema(["a", "time", "note"], ["bigint", "bigint", "varchar"])
    report = load_table(df, name, validate=True, schema=schema)
    assert (report.total, report.valid, report.rejected) == (5, 2, 3)
    assert report.load_id.startswith("load-")
    assert "3 of 5 rows rejected" in caplog.text
    assert {r.note for r in read_table(spark, name).collect()} == {"ok", "null a"}
    assert read_table(spark, name).columns == ["a", "time", "note"]
    bad = {r._row: r._reason for r in spark.table(f"{name}__rejects").collect()}
    assert bad == {
        '{"a":"x","time":"2024-01-01 00:00:01","note":"bad a"}': "a is not bigint",
        '{"a":"3","time":"soon","note":"bad time"}': "time is null",
        '{"note":"no time"}': "time is null",
    }


def test_all_rejected_publishes_nothing(spark, db):
    name = f"{db}.v"
    schema = declared_schema(["a", "time"], ["bigint", "bigint"])
    bad = spark.createDataFrame([("x", 1)], "a string, time int")
    with pytest.raises(NoValidRecordsError):
        load_table(bad, name, validate=True, schema=schema)
    assert not spark.catalog.tableExists(name)
    load_table(spark.createDataFrame([("1", 1)], "a string, time int"), name, schema=schema)
    with pytest.raises(NoValidRecordsError):
        load_table(bad, name, "append", validate=True)
    assert table(spark, name) == [(1, 1)]
    dest = Destination.of(spark, name)
    assert [x.rows for x in loads_of(dest)] == [1] and runs(dest) == 1


def test_validated_append_to_a_plain_table(spark, db):
    name = f"{db}.v"
    load_table(two(spark, 1), name)
    report = load_table(spark.createDataFrame([("2", 1), ("x", 1)], "a string, time int"), name, "append", validate=True)
    assert report.valid == 1
    assert table(spark, name) == [(1, 1), (2, 1)]
    assert spark.table(f"{name}__rejects").count() == 1
    with pytest.raises(ValueError):
        load_table(two(spark, 3), name, "append", load_id="mine")


def test_bad_array_elements_are_rejected(spark, db):
    name = f"{db}.arr"
    schema = declared_schema(["x", "time"], ["array(bigint)", "bigint"])
    df = spark.createDataFrame([(["1", None], 1), (["1", "y"], 1), (None, 1)], "x array<string>, time int")
    assert load_table(df, name, validate=True, schema=schema).valid == 2
    assert sorted((r.x or [] for r in spark.table(name).collect()), key=len) == [[], [1, None]]


def test_repeating_a_load_id(spark, db):
    name = f"{db}.s"
    load_table(two(spark, 1, 2), name, load_id="a")
    load_table(two(spark, 10), name, "append", load_id="b")
    load_table(two(spark, 3), name, "append", load_id="a")
    assert table(spark, name) == [(3, 1), (10, 1)]
    load_table(two(spark, 3), name, "append", load_id="a")
    assert table(spark, name) == [(3, 1), (10, 1)]
    # One folder per live load, none left from those replaced once nothing may read them any more.
    dest = Destination.of(spark, name)
    assert runs(dest) == 4
    spark.conf.set(GRACE_SETTING, "0")
    sweep(dest)
    spark.conf.unset(GRACE_SETTING)
    assert runs(dest) == 2 and table(spark, name) == [(3, 1), (10, 1)]
    load_table(two(spark, 5), name, "append")
    assert table(spark, name) == [(3, 1), (5, 1), (10, 1)]
    load_table(two(spark, 3).where("a > 3"), name, "append", load_id="a", allow_empty=True)
    assert table(spark, name) == [(5, 1), (10, 1)]
    with pytest.raises(ValueError):
        load_table(two(spark, 1), name, "append", load_id="a'b")


def test_session_append_evolves(spark, db):
    name = f"{db}.s"
    load_table(two(spark, 1), name, load_id="a")
    wide = spark.createDataFrame([(2, 1, "new")], "a int, time int, c string")
    with pytest.raises(ValueError):
        load_table(wide, name, "append", load_id="b")
    load_table(wide, name, "append", load_id="b", evolve=True)
    load_table(spark.createDataFrame([(5,)], "time int"), name, "append", load_id="c")
    assert set(table(spark, name)) == {(1, 1, None), (2, 1, "new"), (None, 5, None)}


def test_replay_moves_rejects_too(spark, db):
    name = f"{db}.s"
    schema = declared_schema(["a", "time"], ["bigint", "bigint"])
    first = spark.createDataFrame([("1", 1), ("x", 1)], "a string, time int")
    load_table(first, name, load_id="a", schema=schema)
    load_table(first, name, "append", load_id="a")
    assert spark.table(f"{name}__rejects").count() == 1
    load_table(first.where("a = '1'"), name, "append", load_id="a")
    assert spark.table(f"{name}__rejects").count() == 0
    assert table(spark, name) == [(1, 1)]


def test_overwrite_between_kinds(spark, db):
    name = f"{db}.s"
    load_table(two(spark, 1), name, load_id="a")
    load_table(two(spark, 2), name, "overwrite")
    assert spark.table(name).columns == ["a", "time"] and table(spark, name) == [(2, 1)]
    load_table(two(spark, 3), name, "overwrite", load_id="a")
    assert table(spark, name) == [(3, 1)]
    dest = Destination.of(spark, name)
    store = store_of(dest)
    drop_table(dest)
    assert not dest.exists and not path_exists(spark, store)
    assert not spark.catalog.listTables(db)


def test_files_per_load(spark, db):
    assert rows_per_file(1_000) == 10_000
    assert rows_per_file(10_000_000) == 50_000
    df = spark.range(1000).selectExpr("id AS a", "1 AS time").coalesce(1)
    load_table(df, f"{db}.t", chunk_rows=100)
    assert spark.table(f"{db}.t").select(F.input_file_name()).distinct().count() == 10
    load_table(df, f"{db}.s", chunk_rows=100, validate=True)
    assert spark.table(f"{db}.s").select(F.input_file_name()).distinct().count() == 10


def test_text_types_only_guessed_on_request(spark, db):
    df = spark.createDataFrame([("00012", 1)], "code string, time int")
    load_table(df, f"{db}.a")
    assert spark.table(f"{db}.a").first().code == "00012"
    load_table(df, f"{db}.b", infer_text_types=True)
    assert spark.table(f"{db}.b").first().code == 12


def test_declared_schema(spark, db):
    name = f"{db}.d"
    schema = declared_schema(["b", "a", "c", "time"], ["double", "varchar", "array(bigint)", "bigint"])
    df = spark.createDataFrame([(1, "2.5", 9)], "a int, b string, time int")
    load_table(df, name, schema=schema)
    assert dict(spark.table(name).dtypes) == {"b": "double", "a": "string", "c": "array<bigint>", "time": "bigint"}
    assert tuple(spark.table(name).first()) == (2.5, "1", None, 9)
    extra = df.withColumn("z", F.lit(1))
    with pytest.raises(ValueError):
        load_table(extra, name, "overwrite", schema=schema)
    create_table(spark, f"{db}.open")
    assert spark.table(f"{db}.open").dtypes == [("time", "bigint")]
    load_table(df, f"{db}.open", "append", evolve=True)
    assert spark.table(f"{db}.open").count() == 1
    create_table(spark, f"{db}.fixed", ["time", "x"], ["bigint", "array(varchar)"])
    load_table(spark.createDataFrame([(1, ["q", "nan"])], "time int, x array<string>"), f"{db}.fixed", "append")
    assert spark.table(f"{db}.fixed").first().x == ["q", None]


@pytest.mark.parametrize("extra", [{}, {"load_id": "one"}])
def test_recast(spark, db, extra):
    name = f"{db}.r"
    df = spark.createDataFrame([(["1", None, "3"], "7", 1)], "x array<string>, n string, time int")
    load_table(df, name, keep_arrays=True, **extra)
    if extra:
        load_table(df, name, "append", load_id="two")
    recast_columns(spark, name, [("x", "array<int>", "numbers"), ("n", "bigint")])
    got = read_table(spark, name)
    assert dict(got.dtypes) == {"x": "array<int>", "n": "bigint", "time": "bigint"}
    assert {(tuple(r.x), r.n) for r in got.collect()} == {((1, None, 3), 7)}
    comment = next(r.comment for r in spark.sql(f"DESCRIBE {name}").collect() if r.col_name == "x")
    assert comment == "numbers"
    if extra:
        assert spark.table(name).count() == 2
        recast_columns(spark, name, [("n", "double")])
        load_table(df, name, "append", load_id="two")
        assert spark.table(name).count() == 2
        load_table(df, name, "append", load_id="recast")
        assert spark.table(name).count() == 3
    with pytest.raises(ValueError):
        recast_columns(spark, name, [("nope", "int")])


def test_failed_recast_keeps_the_table(spark, db):
    for name, extra in ((f"{db}.a", {}), (f"{db}.b", {"load_id": "x"})):
        load_table(spark.createDataFrame([("q", 1)], "s string, time int"), name, **extra)
        with pytest.raises(PySparkException):
            recast_columns(spark, name, [("s", "bigint")])
        assert table(spark, name) == [("q", 1)]


def test_day_partitions(spark, db, events):
    name = f"{db}.days"
    load_table(events.drop("ts"), name, day_partitions=True, sort_by_time=True)
    load_table(events.drop("ts"), name, "append")
    whole = read_table(spark, name, limit=None)
    assert "_day" not in whole.columns and whole.count() == 2 * events.count()
    some = read_table(spark, name, time_range=("2024-01-03 12:00", "2024-01-05"), limit=None)
    assert some.count() == 2 * events.where("time >= 1704283200 AND time < 1704412800").count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "_day" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    with pytest.raises(ValueError):
        load_table(events.drop("ts"), name, "append", load_id="x")


def test_store_frame(spark, db):
    rows = [(dt.datetime(2010, 1, 1), dt.datetime(2011, 5, 6), "b"), (dt.datetime(2010, 1, 2), None, "a")]
    df = spark.createDataFrame(rows, "at timestamp_ntz, other timestamp_ntz, v string")
    store_frame(df, f"{db}.a", time_col="at", index=True, order_by="v", date_format="%Y/%m/%d")
    assert table(spark, f"{db}.a") == [(1262304000, "2011/05/06", "b", 1), (1262390400, None, "a", 0)]
    store_frame(df, f"{db}.b", time_key="at")
    assert spark.table(f"{db}.b").columns == ["at", "other", "v", "time"]
    assert spark.table(f"{db}.b").first().at == "2010-01-01 00:00:00"
    with pytest.raises(ValueError):
        store_frame(df.withColumn("time", F.lit(1)), f"{db}.c")
    with pytest.raises(ValueError):
        store_frame(df, f"{db}.c", "bar")


def test_write_csv(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("HOME", str(tmp_path))
    path = write_csv(spark.createDataFrame([(1, "x,y"), (2, None)], "a int, b string"), "~/out")
    assert path == str(tmp_path / "out")
    back = spark.read.csv(path, header=True)
    assert sorted((r.a, r.b) for r in back.collect()) == [("1", "x,y"), ("2", None)]


def test_files_per_load_from_many_partitions(spark, db):
    # Rows that fill their files exactly, coming from more parts than one: no file is split.
    df = spark.range(0, 1000, 1, 7).selectExpr("id AS a", "1 AS time")
    load_table(df, f"{db}.t", chunk_rows=100)
    files = spark.table(f"{db}.t").groupBy(F.input_file_name()).count()
    assert sorted(r["count"] for r in files.collect()) == [100] * 10
