"""Tables of versions: whoever reads meets an old version or a new one, whatever the writer is at."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tidetable import LoadError, load_table, read_table, recast_columns
from tidetable.operators import declared_schema
from tidetable.sinks import Destination, drop_table, fold_loads, loads_of, sessions, snapshots, storage
from tidetable.sinks.snapshots import GRACE_SETTING, current, store_of, sweep
from tidetable.sources import list_databases, list_tables

DAY = 86_400


def days(spark, first, last):
    """One row a day and a half."""
    return spark.range(first, last).selectExpr("id", f"id * {DAY * 3 // 2} AS time")


def numbered(spark, name, n, **options):
    for k in range(n):
        load_table(days(spark, 10 * k, 10 * k + 10), name, "append", load_id=f"q-{k}", **options)


#: What changes a table of 40 rows in four loads, and the rows that it has then.
CHANGES = {
    "overwrite": (lambda spark, name: load_table(days(spark, 0, 7), name, "overwrite"), 7),
    "overwrite in a session": (lambda spark, name: load_table(days(spark, 0, 7), name, "replace", load_id="new"), 7),
    "replay": (lambda spark, name: load_table(days(spark, 13, 16), name, "append", load_id="q-1"), 33),
    "fold": (lambda spark, name: fold_loads(Destination.of(spark, name), "q", 3), 40),
    "recast": (lambda spark, name: recast_columns(spark, name, [("id", "varchar")]), 40),
    "append": (lambda spark, name: load_table(days(spark, 50, 59), name, "append", load_id="q-9"), 49),
}


class Steps:
    """Calls ``each`` before every change of the catalog or the store; may fail at one of them."""

    def __init__(self, monkeypatch, spark, each, fail_at=None):
        self.each, self.fail_at, self.count, self.busy = each, fail_at, 0, False
        real_sql, real_rename, real_delete = type(spark).sql, storage._renamed, storage.delete_path

        def sql(session, text, *args, **kwargs):
            if text.split(" ", 1)[0] in ("ALTER", "CREATE", "DROP"):
                self.step(text)
            return real_sql(session, text, *args, **kwargs)

        def renamed(*args, **kwargs):
            self.step("rename")
            return real_rename(*args, **kwargs)

        def delete(*args):
            self.step("delete")
            return real_delete(*args)

        monkeypatch.setattr(type(spark), "sql", sql)
        monkeypatch.setattr(storage, "_renamed", renamed)
        for module in (sessions, snapshots):
            monkeypatch.setattr(module, "delete_path", delete)

    def step(self, what):
        if self.busy:
            return
        self.busy = True
        self.count += 1
        try:
            self.each(what)
            if self.count == self.fail_at:
                raise RuntimeError(f"lost before: {what}")
        finally:
            self.busy = False


def counts(spark, name):
    return {read_table(spark, name).count(), spark.table(name).count(), spark.sql(f"SELECT * FROM {name}").count()}


@pytest.mark.parametrize("by_day", [False, True])
@pytest.mark.parametrize("change", CHANGES)
def test_readers_meet_old_or_new_at_every_step(spark, db, monkeypatch, change, by_day):
    name = f"{db}.t"
    numbered(spark, name, 4, day_partitions=by_day)
    act, after = CHANGES[change]
    seen = []

    def look(what):
        found = counts(spark, name)
        assert found <= {40, after}, what
        seen.append(found)

    steps = Steps(monkeypatch, spark, look)
    act(spark, name)
    monkeypatch.undo()
    assert steps.count >= 3 and seen[0] == {40} and counts(spark, name) == {after}


@pytest.mark.parametrize("change", CHANGES)
def test_a_writer_lost_at_any_step_leaves_old_or_new(spark, db, monkeypatch, change):
    act, after = CHANGES[change]
    first = f"{db}.t0"
    numbered(spark, first, 4)
    steps = Steps(monkeypatch, spark, lambda what: None)
    act(spark, first)
    monkeypatch.undo()
    for at in range(1, steps.count + 1):
        name = f"{db}.t{at}"
        numbered(spark, name, 4)
        Steps(monkeypatch, spark, lambda what: None, fail_at=at)
        with pytest.raises(RuntimeError, match="lost before"):
            act(spark, name)
        monkeypatch.undo()
        assert counts(spark, name) <= {40, after}
        # The next writer goes on from there.
        load_table(days(spark, 90, 91), name, "append", load_id=None if change.startswith("over") else "q-20")
        assert len(counts(spark, name)) == 1 and counts(spark, name) <= {41, after + 1}


def test_readers_planned_before_a_change_finish(spark, db):
    name = f"{db}.t"
    numbered(spark, name, 4)
    planned = [read_table(spark, name), spark.table(name)]
    for df in planned:
        df._jdf.queryExecution().executedPlan()
    late = spark.table(name)
    fold_loads(Destination.of(spark, name), "q", 3)
    recast_columns(spark, name, [("id", "varchar")])
    load_table(days(spark, 0, 3), name, "overwrite")
    assert [df.count() for df in [*planned, late]] == [40, 40, 40]
    assert counts(spark, name) == {3}


def test_files_go_after_the_grace_period(spark, db):
    name = f"{db}.t"
    numbered(spark, name, 4)
    dest = Destination.of(spark, name)
    before = [x.path for x in loads_of(dest)]
    fold_loads(dest, "q", 3)
    recast_columns(spark, name, [("id", "varchar")])
    assert all(storage.path_exists(spark, p) for p in before) and current(dest).gone
    spark.conf.set(GRACE_SETTING, "0")
    sweep(dest)
    spark.conf.unset(GRACE_SETTING)
    assert not any(storage.path_exists(spark, p) for p in before) and not current(dest).gone
    assert {t.name for t in spark.catalog.listTables(db)} == {"t", current(dest).data}
    assert spark.sql(f"SHOW PARTITIONS {db}.{current(dest).data}").count() == len(loads_of(dest)) == 2
    assert counts(spark, name) == {40}
    store = store_of(dest)
    drop_table(dest)
    assert not storage.path_exists(spark, store) and not spark.catalog.listTables(db)


@pytest.mark.parametrize("by_day", [False, True])
def test_what_a_lost_writer_left_is_cleared(spark, db, monkeypatch, by_day):
    name = f"{db}.t"
    numbered(spark, name, 2, day_partitions=by_day)
    Steps(monkeypatch, spark, lambda what: None, fail_at=2)
    with pytest.raises(RuntimeError, match="lost before"):
        load_table(days(spark, 50, 53), name, "append", load_id="lost")
    monkeypatch.undo()
    dest = Destination.of(spark, name)
    assert snapshots.vacuum(dest) == []
    assert [x.split(".")[0] for x in snapshots.vacuum(dest, 0)] == ["lost"]
    assert counts(spark, name) == {20}
    load_table(days(spark, 50, 53), name, "append", load_id="lost")
    assert counts(spark, name) == {23} and snapshots.vacuum(dest, 0) == []


def test_writers_at_the_same_time(spark, db):
    name = f"{db}.t"
    load_table(days(spark, 0, 1), name, load_id="first")
    failed = []

    def write(k):
        try:
            for part in range(3):
                rows = days(spark, 100 * k + 10 * part, 100 * k + 10 * part + 10)
                load_table(rows, name, "append", load_id=f"w{k}-{part}")
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and counts(spark, name) == {121}
    assert len(loads_of(Destination.of(spark, name))) == 13


def test_an_append_to_a_replaced_table_is_refused(spark, db, monkeypatch):
    name = f"{db}.t"
    load_table(days(spark, 0, 4), name)
    real = sessions.publish

    def overtaken(*args, **kwargs):
        monkeypatch.undo()
        load_table(days(spark, 0, 2), name, "overwrite")
        return real(*args, **kwargs)

    monkeypatch.setattr(sessions, "publish", overtaken)
    with pytest.raises(LoadError, match="load it again"):
        load_table(days(spark, 4, 9), name, "append")
    assert counts(spark, name) == {2}


def test_time_ranges_leave_out_loads(spark, db):
    name = f"{db}.t"
    for k in range(30):
        rows = spark.range(3).selectExpr(f"{k} AS k", f"{k * DAY} + id AS time")
        load_table(rows, name, "append", load_id=f"q-{k}", publish=False)
    inside = read_table(spark, name, time_range=(10 * DAY, 12 * DAY))
    assert {r.k for r in inside.collect()} == {10, 11}
    runs = [x.run for x in loads_of(Destination.of(spark, name))]
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert [r for r in runs if r in plan] == [r for r in runs if r.split(".")[0] in ("q-10", "q-11")]
    assert len(inside.inputFiles()) < len(read_table(spark, name).inputFiles()) / 5
    assert read_table(spark, name, time_range=(99 * DAY, None)).count() == 0
    untimed = f"{db}.u"
    load_table(spark.range(3), untimed, add_time=False)
    load_table(spark.createDataFrame([(1, None)], "id long, time long"), f"{db}.n")
    assert read_table(spark, f"{db}.n", time_range=(0, 1)).count() == 0 and read_table(spark, f"{db}.n").count() == 1


def test_unpublished_loads_are_read_and_shown_later(spark, db):
    name = f"{db}.t"
    load_table(days(spark, 0, 2), name, load_id="a")
    load_table(days(spark, 2, 5), name, "append", load_id="b", publish=False)
    assert read_table(spark, name).count() == 5 and spark.table(name).count() == 2
    load_table(days(spark, 5, 6), name, "append", load_id="c")
    assert counts(spark, name) == {6}


def test_the_inventory_reads_no_table_of_versions(spark, db):
    name = f"{db}.t"
    numbered(spark, name, 3)
    load_table(days(spark, 30, 40).withColumn("id", F.col("id").cast("string")), f"{db}.p")
    days(spark, 0, 5).write.saveAsTable(f"{db}.plain")
    schema = declared_schema(["id", "time"], ["bigint", "bigint"])
    load_table(spark.createDataFrame([("1", 1), ("x", 1)], "id string, time int"), f"{db}.v", validate=True, schema=schema)
    spark.sql(f"CREATE VIEW {db}.other AS SELECT 1 AS one")
    listed = list_tables(spark, database=db)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "BatchScan" not in plan
    rows = {r.name: r for r in listed.collect()}
    assert {n: r["count"] for n, r in rows.items()} == {"t": 30, "p": 10, "plain": 5, "v": 1, "v__rejects": 1}
    assert all(r.estimated_storage_size > 100 and r.created_at is not None for r in rows.values())
    last = spark.table(name).agg(F.max(F.timestamp_seconds("time"))).first()[0]
    assert rows["t"].last_log_timestamp == last and rows["plain"].last_log_timestamp is not None
    assert list_databases(spark, db).first()["count"] == 47


def test_counts_of_plain_tables_come_from_footers(spark, db):
    from tidetable.session import isolated_session
    from tidetable.sources import catalog

    days(spark, 0, 50).write.saveAsTable(f"{db}.plain")
    footers = isolated_session(spark, catalog._FOOTERS)
    details = catalog._details(spark, f"{db}.plain")
    scan = catalog._of_footers(footers, spark.table(f"{db}.plain"), details)
    plan = scan.agg(F.count(F.lit(1)), F.max("time"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(time)]" in plan


def test_a_plain_table_is_overwritten_by_one_of_versions(spark, db, monkeypatch):
    name = f"{db}.t"
    days(spark, 0, 4).write.saveAsTable(name)
    load_table(days(spark, 4, 6), name, "append")
    assert spark.table(name).count() == 6 and current(Destination.of(spark, name)) is None
    real = type(spark).sql

    def failing(session, text, *args, **kwargs):
        if text.startswith("CREATE VIEW"):
            raise RuntimeError("the catalog is away")
        return real(session, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        load_table(days(spark, 0, 3), name, "overwrite")
    monkeypatch.undo()
    assert spark.table(name).count() == 6
    load_table(days(spark, 0, 3), name, "overwrite")
    assert counts(spark, name) == {3}
    assert not [t.name for t in spark.catalog.listTables(db) if "__old_" in t.name]


def test_folds_of_one_load_are_refused(spark, db):
    load_table(days(spark, 0, 1), f"{db}.t", load_id="q-0")
    for every in (1, 0, -3):
        with pytest.raises(ValueError, match="2 loads at least"):
            fold_loads(Destination.of(spark, f"{db}.t"), "q", every)
