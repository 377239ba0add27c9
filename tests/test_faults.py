"""Losses and half-done work that must not come back."""

from __future__ import annotations

import datetime as dt
import pathlib

import pandas as pd
import pytest
from pyspark.errors.exceptions.captured import SparkRuntimeException
from pyspark.sql import functions as F

from tidetable.functions.timefuncs import as_epoch, epoch_trunc
from tidetable.operators import (
    add_row_index,
    convert_time,
    declared_schema,
    drop_null_columns,
    parse_dates,
    pivot_result,
    shape_result,
    shift_timezone,
)
from tidetable.session import isolated_session
from tidetable.sinks import Destination, load_table, loads_of, recast_columns, store_frame, write_csv
from tidetable.sinks.sessions import covering_load, fold_loads
from tidetable.sinks.storage import path_exists
from tidetable.sources import list_tables, read_table, run_query

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("work", ["shape", "chunks", "result"])
def test_rows_are_made_once(spark, db, tmp_path, work):
    total = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    source = spark.range(0, 900, 1, 4).mapInArrow(count, "id long")
    if work == "shape":
        rows = source.selectExpr("id % 10 AS time", "CAST(id % 3 AS STRING) AS kind", "id AS v")
        grouped = rows.groupBy("time", "kind").agg(F.max("v").alias("v"), F.lit(None).cast("double").alias("none"))
        assert shape_result(grouped, dropna=True, pivot=True).count() == 10
    elif work == "chunks":
        load_table(source, f"{db}.t", chunk_rows=100)
        files = spark.table(f"{db}.t").groupBy(F.input_file_name()).count().collect()
        assert len(files) == 9 and max(r["count"] for r in files) <= 100
    else:
        source.createOrReplaceTempView("counted_rows")
        out = run_query(spark, "SELECT id FROM counted_rows", result_url=str(tmp_path / "out"))
        assert out.count() == 900
        assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 900
        spark.catalog.dropTempView("counted_rows")
    assert total.value == 900


def test_pivot_names_must_differ(spark):
    clash = spark.createDataFrame([(1, "time", 1.0)], "time int, kind string, v double")
    with pytest.raises(ValueError, match="share a name"):
        pivot_result(clash)
    two = spark.createDataFrame([(1, "a", 1.0, 2.0), (1, "a_b", 1.0, 2.0)], "k int, kind string, b_c double, c double")
    with pytest.raises(ValueError, match="share a name"):
        pivot_result(two)
    with pytest.raises(SparkRuntimeException, match="not among"):
        pivot_result(spark.createDataFrame([(1, "b", 1.0)], "k int, kind string, v double"), ["a"]).collect()


def test_a_time_column_is_never_replaced(spark, db):
    df = spark.createDataFrame([(1, 5)], "k int, TIME int")
    with pytest.raises(ValueError, match="already has a 'time'"):
        store_frame(df, f"{db}.t")
    store_frame(df, f"{db}.t", time_col="TIME")
    assert spark.table(f"{db}.t").select("k", "time").collect() == [(1, 5)]


def test_time_key_from_an_index_level(spark, db):
    at = pd.DatetimeIndex(["2024-01-02", "2024-01-03"], name="at")
    frame = pd.DataFrame({"v": [1, 2]}, index=at)
    store_frame(frame, f"{db}.a", spark=spark, time_key="at")
    assert sorted(map(tuple, spark.table(f"{db}.a").select("v", "time").collect())) == [(1, 1704153600), (2, 1704240000)]
    assert "at" not in spark.table(f"{db}.a").columns
    store_frame(frame, f"{db}.b", spark=spark, time_key="at", index=True)
    assert set(spark.table(f"{db}.b").columns) == {"v", "at", "time"}


def test_any_session_zone(spark):
    other = isolated_session(spark, {"spark.sql.session.timeZone": "America/New_York"})
    text = ["2024-03-10 02:30:00", "2024-03-10T02:30:00+09:00", "2024-03-10", "1969-12-31 23:59:59.5"]
    df = other.createDataFrame([(t,) for t in text], "t string")
    kind = df.schema["t"].dataType
    got = [r[0] for r in df.select(as_epoch(F.col("t"), kind)).collect()]
    assert got == [1710037800, 1710005400, 1710028800, -1]
    ntz = df.select(F.col("t").cast("timestamp_ntz").alias("t")).limit(1)
    assert ntz.select(as_epoch(F.col("t"), ntz.schema["t"].dataType)).first()[0] == 1710037800
    one = other.createDataFrame([(text[0],)], "t string")
    formatted = one.select(as_epoch(F.col("t"), kind, "yyyy-MM-dd HH:mm:ss"))
    assert formatted.first()[0] == 1710037800
    month = other.range(1).select(epoch_trunc("month", F.lit(1710037800).cast("bigint")))
    assert month.first()[0] == 1709251200
    assert other.sql("SELECT epoch_trunc('week', 1710037800L), time_range(5, '1970-01-01 00:00:05', NULL)").first()[:] == (
        1709510400,
        True,
    )


def test_fractions_of_time_units(spark):
    df = spark.createDataFrame([(1.5,)], "t double")
    micros = F.unix_micros("t")
    assert parse_dates(df, {"t": "ms"}).select(micros).first()[0] == 1500
    assert parse_dates(df, {"t": "us"}).select(micros).first()[0] == 1


def test_declared_loads_keep_values(spark, db):
    schema = declared_schema(
        ["k", "raw", "m", "f", "g"], ["bigint", "binary", "map(varchar, bigint)", "double", "array(double)"]
    )
    rows = [(1, bytearray(b"hi"), {"a": 1}, "NaN", ["1", "NaN"])]
    df = spark.createDataFrame(rows, "k long, raw binary, m map<string,int>, f string, g array<string>")
    load_table(df, f"{db}.t", schema=schema, add_time=False, keep_arrays=True)
    assert spark.table(f"{db}.t").first()[:] == (1, bytearray(b"hi"), {"a": 1}, None, [1.0, None])
    load_table(df.select("k", "raw"), f"{db}.t", "append", add_time=False)
    assert spark.table(f"{db}.t").where("m IS NULL").first().raw == bytearray(b"hi")


def test_validated_loads_reject_losses(spark, db):
    schema = declared_schema(["v", "n", "time"], ["bigint", "real", "bigint"])
    df = spark.createDataFrame([(1.7, 0.1, 1), (2.0, 0.1, 2), (None, None, 3)], "v double, n double, time long")
    load_table(df, f"{db}.t", validate=True, schema=schema)
    assert sorted(r.time for r in spark.table(f"{db}.t").collect()) == [2, 3]
    assert "v is not bigint" in spark.table(f"{db}.t__rejects").first()["_reason"]


def test_recast_turns_nan_to_null(spark, db):
    load_table(spark.createDataFrame([("NaN",), ("2.5",)], "v string"), f"{db}.t", add_time=False)
    recast_columns(spark, f"{db}.t", [("v", "double")])
    assert sorted(spark.table(f"{db}.t").collect(), key=str) == [(2.5,), (None,)]


def test_csv_of_nested_columns(spark, tmp_path):
    df = spark.createDataFrame([([1, 2], {"a": 1}, b"hi", 3)], "a array<int>, m map<string,int>, b binary, n int")
    path = write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(path).first()[:] == ("[1, 2]", '{"a":1}', "aGk=", "3")


def test_parameters_inside_literals(spark):
    spark.range(3).selectExpr("concat('x', id, 'y') AS t").createOrReplaceTempView("texts")
    out = run_query(spark, "SELECT t FROM texts WHERE t LIKE '%{part}%' AND t <> 'it''s'", {"part": "1"})
    assert [r.t for r in out.collect()] == ["x1y"]
    spark.catalog.dropTempView("texts")


def test_loads_fold(spark, db):
    name = f"{db}.t"
    dest = Destination.of(spark, name)
    for k in range(20):
        load_table(spark.range(k, k + 1), name, "append", load_id=f"q-{k}")
        if (k + 1) % 3 == 0:
            fold_loads(dest, "q", 3)
            assert len(loads_of(dest)) <= 7
    load_table(spark.range(19, 20), name, "append", load_id="q-19")
    assert sorted(r.id for r in read_table(spark, name, ["id"]).collect()) == list(range(20))
    assert covering_load(dest, "q", 4) and not covering_load(dest, "q", 19)


def test_folds_of_dense_and_sparse_loads_keep_all_rows(spark, db):
    """0_1 and 10_11 are of one size, 2_9 between them is of another; of the good rows and of the rejects."""
    name = f"{db}.t"
    numbers = [0, 1, 2, 9, 10, 11, 12, 13]
    for k in numbers:
        rows = spark.createDataFrame([(f"good{k}", "1970-01-02 00:00:00"), (f"bad{k}", "soon")], "id string, at string")
        load_table(rows, name, "append", load_id=f"q-{k}", time_col="at")
        fold_loads(Destination.of(spark, name), "q", 2)
    assert sorted(r.id for r in read_table(spark, name, ["id"]).collect()) == sorted(f"good{k}" for k in numbers)
    rejects = [r[0] for r in spark.table(f"{name}__rejects").select("_row").collect()]
    assert len(rejects) == len(numbers) and all(any(f'"bad{k}"' in r for r in rejects) for k in numbers)
    for t in (name, f"{name}__rejects"):
        assert {x.load_id for x in loads_of(Destination.of(spark, t))} == {"q-0_11", "q-12", "q-13"}


def test_listing_writes_nothing(spark, db):
    load_table(spark.range(5), f"{db}.t")
    before = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").collect()
    row = list_tables(spark, database=db).first()
    assert row["count"] == 5 and row.estimated_storage_size > 0 and row.created_at is not None
    assert spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").collect() == before
    unread = list_tables(spark, database=db, exact=False)
    assert unread.first()["count"] is None and unread.first().estimated_storage_size > 0


def test_loads_divided_by_day(spark, db):
    name, day = f"{db}.t", 86_400
    rows = spark.range(12).selectExpr("id", f"(id % 4) * {day} + id AS time")
    for part in (0, 1, 2):
        load_table(rows.where(f"id % 3 = {part}"), name, "append", load_id=f"q-{part}", day_partitions=True)
    load_table(rows.where("id % 3 = 1 AND id < 5"), name, "append", load_id="q-1")
    want = [i for i in range(12) if i % 3 != 1 or i < 5]
    assert sorted(r.id for r in read_table(spark, name, ["id"]).collect()) == want
    assert spark.table(name).schema["_day"].dataType.simpleString() == "date"
    inside = read_table(spark, name, ["id"], time_range=(day, 2 * day))
    assert sorted(r.id for r in inside.collect()) == [i for i in want if i % 4 == 1]
    assert "_day" in inside._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
    recast_columns(spark, name, [("id", "varchar")])
    assert sorted(int(r.id) for r in read_table(spark, name, ["id"]).collect()) == want
    fold_loads(Destination.of(spark, name), "q", 2)
    assert {x.load_id for x in loads_of(Destination.of(spark, name))} == {"q-0_1", "q-2"}
    assert sorted(int(r.id) for r in read_table(spark, name, ["id"]).collect()) == want
    bad = spark.createDataFrame([("5", "soon"), ("6", "1970-01-02 00:00:00")], "id string, at string")
    load_table(bad, name, "append", load_id="q-3", time_col="at")
    assert spark.table(f"{name}__rejects").count() == 1
    assert "6" in {r.id for r in read_table(spark, name, ["id"], time_range=(day, 2 * day)).collect()}


def test_row_index_in_given_partitions(spark):
    df = spark.range(0, 500, 1, 3).selectExpr("id", "id % 2 AS k")
    rows = add_row_index(df, ["k", "id"], "at", partitions=17).collect()
    assert [r.at for r in sorted(rows, key=lambda r: (r.k, r.id))] == list(range(500))


def test_pivot_keeps_rows_that_change_between_evaluations(spark):
    """Each evaluation of the function gives other marks; names and cells come from one of them."""

    @F.udf("string")
    def mark(k):
        import random

        return f"m{random.randrange(10**6)}"

    rows = spark.range(1000).select(F.col("id").alias("key"), mark("id").alias("kind"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.pivotMaxValues", "2000")
    wide = pivot_result(rows)
    cells = wide.select(F.explode(F.array(*[F.col(f"`{c}`") for c in wide.columns[1:]])).alias("v")).where("v IS NOT NULL")
    assert cells.count() == 1000
    drawn = spark.range(50).select("id", F.floor(F.rand() * 5).cast("string").alias("kind"), F.col("id").alias("v"))
    wide = pivot_result(drawn)
    assert wide.count() == 50 and sum(v is not None for r in wide.collect() for v in r[1:]) == 50
    spark.conf.unset("spark.sql.pivotMaxValues")


def test_what_counts_as_a_scan(spark, tmp_path):
    from tidetable.operators.shape import _is_scan

    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    files = spark.read.parquet(path)
    assert _is_scan(files) and _is_scan(files.where("id > 1").selectExpr("id + 1 AS x"))
    touched = F.udf(lambda x: x, "long")("id")
    for other in (files.select(F.rand()), files.select(touched), files.where(F.rand(3) > 0.5), files.groupBy("id").count(), spark.range(3)):
        assert not _is_scan(other)


def test_null_columns_of_one_evaluation(spark):
    total = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    made = spark.range(0, 300, 1, 3).mapInArrow(count, "id long").withColumn("none", F.lit(None).cast("double"))
    assert drop_null_columns(made).columns == ["id"] and total.value == 300
    assert drop_null_columns(made.where("id < 0")).columns == []


def test_times_in_a_session_of_another_zone(spark):
    tokyo = isolated_session(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"})
    text = tokyo.createDataFrame([("2024-01-01 00:00:00.25", "01/02/2024", "2024-03-10T02:30:00+09:00")], "time string, d string, z string")
    parsed = parse_dates(text, ["time", "z"])
    assert parsed.select(F.unix_micros("time"), F.unix_seconds("z")).first()[:] == (1704067200250000, 1710005400)
    assert parse_dates(text, {"d": "%d/%m/%Y"}).select(F.unix_seconds("d")).first()[0] == 1706745600
    assert convert_time(text).select(F.unix_millis("time")).first()[0] == 1704067200250
    shown = shift_timezone(convert_time(text), "America/New_York").first().time
    assert shown == dt.datetime(2023, 12, 31, 19, 0, 0, 250000)
    gap = isolated_session(spark, {"spark.sql.session.timeZone": "America/New_York"})
    late = gap.createDataFrame([(1710037800,), (-1,)], "time long")
    assert [r.time for r in shift_timezone(convert_time(late), "UTC").collect()] == [
        dt.datetime(2024, 3, 10, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59)
    ]


def test_placeholders_in_all_forms_of_text(spark):
    cases = {
        """SELECT "%{w}%" AS t""": "%x%",
        """SELECT r'\\d{w}' AS t""": "\\\\dx".replace("\\\\", "\\"),
        """SELECT R"{w}y" AS t""": "xy",
        "SELECT 'it''s {w}' AS t -- it's {w}": "it's x",
        "SELECT /* don't */ '{w}' AS t": "x",
        """SELECT /* a /* b' */ " */ concat('{w}', "'") AS t""": "x'",
        """SELECT 'say "{w}"' AS t""": 'say "x"',
        "SELECT `t` FROM (SELECT {w} AS `t`)": "x",
        "SELECT :w AS t, '{3}' AS u": "x",
    }
    for text, want in cases.items():
        assert run_query(spark, text, {"w": "x"}).first().t == want, text
    for text, params in (
        ("SELECT {a}", {"b": 1}), ("SELECT {a}", {"a": 1, "b": 2}), ("SELECT '{a}' -- {b}", {"a": 1, "b": 2}),
        ("SELECT `x{a}`", {"a": 1}), ("SELECT 'open {a}", {"a": 1}), ("SELECT /* {a}", {"a": 1}),
    ):
        with pytest.raises(ValueError):
            run_query(spark, text, params)


def test_results_tell_their_state(spark, tmp_path, monkeypatch):
    import json
    import threading
    import time

    from tidetable import ResultFailedError, ResultNotReadyError, read_result, save_result
    from tidetable.sources import results

    root = str(tmp_path)
    broken = spark.range(3).selectExpr("raise_error('no such luck') AS x")
    with pytest.raises(SparkRuntimeException):
        save_result(broken, "a", root)
    with pytest.raises(ResultFailedError, match="no such luck"):
        read_result(spark, "a", root, wait_seconds=60)
    save_result(spark.range(3), "a", root)
    assert read_result(spark, "a", root).count() == 3
    monkeypatch.setattr(results, "BEAT", 0.1)
    folder = tmp_path / "results"

    def slow(batches):
        for batch in batches:
            time.sleep(2)
            yield batch

    writer = threading.Thread(target=save_result, args=(spark.range(0, 3, 1, 1).mapInArrow(slow, "id long"), "b", root))
    writer.start()
    while not (folder / "b.status").exists():
        time.sleep(0.05)
    began = json.loads((folder / "b.status").read_text())["at"]
    with pytest.raises(ResultNotReadyError, match="not finished"):
        read_result(spark, "b", root, wait_seconds=0.5)
    assert read_result(spark, "b", root, wait_seconds=60).count() == 3
    writer.join()
    status = json.loads((folder / "b.status").read_text())
    assert status["state"] == "done" and status["at"] > began
    (folder / "c.status").write_text(json.dumps({"state": "running", "at": time.time() - 3600, "cause": None}))
    with pytest.raises(ResultNotReadyError, match="its writer is gone"):
        read_result(spark, "c", root, wait_seconds=60)
    save_result(spark.range(2), "c", root)
    assert read_result(spark, "c", root).count() == 2


def test_scratch_goes_with_its_application(spark, tmp_path):
    import json
    import subprocess
    import sys
    import time

    shared = tmp_path / "shared"
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from tidetable.session import get_spark, written
spark = get_spark(**{{"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": {str(shared)!r},
    "spark.sql.warehouse.dir": {str(tmp_path / "wh")!r}}})
assert written(spark.range(5), "kept").count() == 5
import os
top = os.path.join({str(shared)!r}, "tidetable")
names = os.listdir(top)
assert "gone" not in names and "live" in names, names
print("made", os.listdir(os.path.join(top, spark.sparkContext.applicationId)))
"""
    for name, at in (("gone", 0), ("live", time.time())):
        (shared / "tidetable" / name).mkdir(parents=True)
        (shared / "tidetable" / name / "owner.json").write_text(json.dumps({"application": name, "at": at}))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert "kept" in done.stdout, done.stderr[-2000:]
    assert [p.name for p in (shared / "tidetable").iterdir()] == ["live"]


def test_what_is_read_no_more_is_discarded(spark):
    from tidetable.session import discard, written

    df = written(spark.range(3), "once")
    assert path_exists(spark, df._written_at)
    discard(df)
    assert not path_exists(spark, df._written_at)
    discard(spark.range(3))
