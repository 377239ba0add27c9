"""Loads: staged once, counted, published as one new version of the table.

A load writes its files once, into a folder of its own in the table's store, split into good and
rejected rows if it is validated. Rows, valid rows and the range of times are counted in the same
pass. Publishing names the files in the next version, so nothing is copied, a load appears at once
or not at all, with all its days, and repeating an id replaces that load's rows.
"""

from __future__ import annotations

import logging
import re
import time as clock
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.errors import LoadError, NoValidRecordsError
from tidetable.functions.timefuncs import utc_day
from tidetable.operators.declared import REASON, REJECTED, ROW, conform_checked, declared_schema
from tidetable.operators.timecols import TIME, TIME_TEXT
from tidetable.session import sql_settings
from tidetable.sinks import snapshots
from tidetable.sinks.snapshots import RUN, Gone, Load, Snapshot, commit, current, new_run, run_folder, stage
from tidetable.sinks.storage import child_names, delete_path, size_of
from tidetable.sinks.tables import DAY, Destination, add_columns, insert_by_name

logger = logging.getLogger(__name__)

# Stands for the day of rejected rows while a load is staged.
NO_DAY = "none"

_REJECTS_SCHEMA = T.StructType(
    [T.StructField(ROW, T.StringType()), T.StructField(REASON, T.StringType())]
)


def check_load_id(load_id: str | None) -> str:
    """The given id if it is safe to use in names, or a new one."""
    if load_id is None:
        return f"load-{uuid.uuid4().hex}"
    if not re.fullmatch(r"[A-Za-z0-9_-]+", load_id):
        raise ValueError(f"load id may hold letters, digits, - and _ only: {load_id!r}")
    return load_id


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def written_days(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The days that files at ``path`` are divided into."""
    return tuple(sorted(n.split("=", 1)[1] for n in child_names(spark, path) if n.startswith(f"{DAY}=")))


def _as_target(frame: DataFrame, target: T.StructType, evolve: bool) -> DataFrame:
    """``frame`` by name as the columns of ``target``, with Spark's rules for storing values."""
    extra = [f for f in frame.schema if f.name not in target.names]
    if extra and not evolve:
        raise AnalysisException(f"columns not in the table: {', '.join(f.name for f in extra)}")
    return frame.to(nullable(T.StructType([*target, *extra])))


def _range_of_times(schema: T.StructType, valid: Column) -> list[Column]:
    has_time = TIME in schema.names and isinstance(schema[TIME].dataType, T.LongType)
    time = F.when(valid, F.col(TIME)) if has_time else F.lit(None).cast("bigint")
    return [F.min(time).alias("least"), F.max(time).alias("last")]


def run_load(
    df: DataFrame,
    dest: Destination,
    mode: str,
    checked: bool,
    now: Snapshot | None = None,
    schema: T.StructType | None = None,
    evolve: bool = False,
    load_id: str | None = None,
    allow_empty: bool = False,
    write_settings: dict[str, str] | None = None,
    by_day: bool = False,
    sort_by_time: bool = False,
    view: bool = True,
) -> tuple[str, int, int]:
    """Stage, count, publish. Returns the load id and the total and valid row counts.

    ``mode`` is ``create``, ``overwrite`` or ``append``; ``now`` is the version that ``dest`` has, if it
    has versions. ``checked`` sets rows aside that do not fit;
    without it such a row fails the load. ``by_day`` files the rows by their day too, so that time
    ranges skip files. No valid row: nothing is published and :class:`NoValidRecordsError` is raised
    (unless ``allow_empty``).
    """
    spark = dest.spark
    given, load_id = load_id, check_load_id(load_id)
    appending = mode == "append"
    foreign = appending and now is None
    if given is not None and appending and (now is None or not now.named):
        raise ValueError(f"{dest.sql} was not created by a load session, so a load id cannot be replaced in it")
    target = None if not appending else dest.schema if now is None else now.schema
    if checked:
        declared = schema or target or T.StructType([f for f in df.schema if f.name != TIME_TEXT])
        rows = conform_checked(df, declared, evolve)
        good_row = ~F.col(REJECTED)
    else:
        rows = df if target is None else _as_target(df, target, evolve)
        good_row = F.lit(True)
    stored = nullable(T.StructType([f for f in rows.schema if f.name not in (REJECTED, REASON, ROW)]))

    store = (now and snapshots.store_of(dest)) or snapshots.new_store(dest)
    run = new_run(load_id)
    path = run_folder(store, run)
    split = [REJECTED] if checked else []
    if by_day:
        day = utc_day(F.col(TIME))
        rows = rows.withColumn(DAY, F.when(good_row, day.cast("string")).otherwise(NO_DAY) if checked else day)
        split.append(DAY)
        if not checked:
            # Rebalancing gathers a day's rows and lets AQE split the days that are too big.
            rows = rows.hint("rebalance", DAY)
    if sort_by_time:
        rows = rows.sortWithinPartitions(*([DAY] if by_day and not checked else []), TIME)
    seen = Observation()
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(good_row, 1)).alias("valid"),
        *_range_of_times(stored, good_row),
    )
    # A few open files per task instead of a sort on the split columns.
    settings = dict(write_settings or {})
    if checked:
        settings["spark.sql.maxConcurrentOutputFileWriters"] = "32" if by_day else "2"
    try:
        with sql_settings(spark, settings):
            observed.write.partitionBy(*split).parquet(path) if split else observed.write.parquet(path)
        total, valid = seen.get["total"], seen.get["valid"]
        if total > valid:
            logger.warning("load %s: %d of %d rows rejected", load_id, total - valid, total)
        if not valid and not (allow_empty and not total):
            raise NoValidRecordsError(f"load {load_id}: none of {total} rows can be stored in {dest.sql}")
    except BaseException:
        delete_path(spark, path)
        raise
    good = f"{path}/{REJECTED}=false" if checked else path
    bad = f"{path}/{REJECTED}=true" + (f"/{DAY}={NO_DAY}" if by_day else "")
    if not valid:
        delete_path(spark, path)
        if checked and not appending:
            return load_id, total, valid
    if foreign:
        if valid:
            days = [T.StructField(DAY, T.DateType())] if by_day else []
            add_columns(dest, [f for f in stored if f.name not in target.names])
            insert_by_name(dest, spark.read.schema(T.StructType([*stored, *days])).parquet(good))
            delete_path(spark, good)
    else:
        load = None
        if valid:
            days = written_days(spark, good) if by_day else None
            load = Load(run, good, valid, size_of(spark, good), seen.get["least"], seen.get["last"], days)
        after = publish(dest, now, store, mode, stored, checked, by_day, load, load_id, view)
        snapshots.sweep(dest, after)
    if total > valid:
        keep_rejects(dest, load_id, Load(run, bad, total - valid, size_of(spark, bad)), view)
    elif given is not None or not appending:
        keep_rejects(dest, load_id, None, view, appending)
    return load_id, total, valid


def publish(
    dest: Destination,
    now: Snapshot | None,
    store: str,
    mode: str,
    stored: T.StructType,
    named: bool,
    by_day: bool,
    load: Load | None,
    load_id: str,
    view: bool = True,
) -> Snapshot:
    """Name a staged load (None: no rows) in the next version of ``dest``, which is returned."""
    if mode == "append":
        columns = [f for f in stored if f.name not in now.schema.names]
        add_columns(dest, columns, now.data)
        stage(dest, now.data, [load] if load else [])

        def added(newest: Snapshot) -> Snapshot:
            if newest.data != now.data:
                raise LoadError(f"{dest.sql} was replaced while load {load_id} was written; load it again")
            more = [f for f in stored if f.name not in newest.schema.names]
            wide = replace(newest, schema=T.StructType([*newest.schema, *more]))
            if load is None:
                return wide.without([x for x in wide.loads if x.load_id == load_id])
            return wide.instead(load)

        return commit(dest, added, view, now)
    # The new files are complete, under names of their own, before the next version names them.
    data = snapshots.create_data(dest, store, stored, by_day)
    loads = (load,) if load else ()
    stage(dest, data, loads)
    if now is None:
        first = Snapshot(1, data, stored, named, by_day, loads)
        snapshots.create(dest, store, first)
        return first

    def replaced(newest: Snapshot) -> Snapshot:
        emptied = newest.without(newest.loads)
        return Snapshot(0, data, stored, named, by_day, loads, (*emptied.gone, Gone(clock.time(), newest.data)))

    return commit(dest, replaced, view, now)


def keep_rejects(dest: Destination, load_id: str, load: Load | None, view: bool = True, appending: bool = True) -> None:
    """Let the table of rejects hold ``load`` (None: nothing) in the place of what it held of that id."""
    rejects = dest.rejects
    now = current(rejects)
    if now is not None and not appending and load is None:
        snapshots.drop(rejects)
    elif now is not None:
        if load is not None:
            stage(rejects, now.data, [load])
        elif not any(x.load_id == load_id for x in now.loads):
            return
        commit(
            rejects,
            lambda s: s.instead(load) if load is not None else s.without([x for x in s.loads if x.load_id == load_id]),
            view,
        )
        snapshots.sweep(rejects)
    elif load is not None:
        store = snapshots.new_store(rejects)
        data = snapshots.create_data(rejects, store, _REJECTS_SCHEMA, False)
        stage(rejects, data, [load])
        snapshots.create(rejects, store, Snapshot(1, data, _REJECTS_SCHEMA, True, False, (load,)))


def create_table(
    spark: SparkSession, name: str, names: Sequence[str] = (), types: Sequence[str] = ()
) -> None:
    """Create an empty table with declared columns, or an open one that has ``time`` only."""
    schema = declared_schema(names, types)
    if not schema.fields:
        schema = declared_schema(["time"], ["bigint"])
    dest = Destination.of(spark, name)
    store = snapshots.new_store(dest)
    publish(dest, None, store, "create", nullable(schema), False, False, None, "")


def drop_table(dest: Destination) -> None:
    """Drop a table together with its versions, files and rejects."""
    for table in (dest, dest.rejects):
        if current(table) is not None:
            snapshots.drop(table)
        elif table.exists:
            dest.spark.sql(f"DROP TABLE IF EXISTS {table.sql}")


def loads_of(dest: Destination) -> tuple[Load, ...]:
    """The loads that a table holds now."""
    now = current(dest)
    return () if now is None else now.loads


FOLD_EVERY = 50


def check_fold_every(every: int) -> int:
    if every < 2:
        raise ValueError(f"a fold takes 2 loads at least, not {every}")
    return every


def fold_loads(dest: Destination, name: str, every: int = FOLD_EVERY, view: bool = True) -> None:
    """Fold finished loads ``<name>-<number>`` into loads ``<name>-<first>_<last>`` of many.

    As soon as there are ``every`` loads of one size, they and all loads of other sizes that lie
    between them become one, and the results are folded again in turn; so the number of
    loads grows with the logarithm of that of the loads made. The newest load is left alone, as it
    may be run again. One version holds the parts, the next the folded load in their place.
    """
    check_fold_every(every)
    for table in (dest, dest.rejects):
        while (now := current(table)) is not None and (spans := _full_span(now, name, every)):
            if not _fold(table, now, name, spans, view):
                break
        snapshots.sweep(table)


def _spans(snapshot: Snapshot, name: str) -> dict[tuple[int, int], Load]:
    """Loads of that name by their first and last number."""
    found = {}
    for load in snapshot.loads:
        match = re.fullmatch(rf"{re.escape(name)}-(\d+)(?:_(\d+))?", load.load_id)
        if match:
            found[int(match[1]), int(match[2] or match[1])] = load
    return found


def covering_load(dest: Destination, name: str, number: int) -> bool:
    """Whether a folded load already holds the load of that number."""
    now = current(dest)
    return now is not None and any(first <= number <= last and first < last for first, last in _spans(now, name))


def _full_span(snapshot: Snapshot, name: str, every: int) -> list[tuple[int, int]]:
    """All finished loads from the first to the last one of the smallest size that has ``every`` loads.

    Sizes are by numbers, which batches without rows leave out, so loads of another size may lie
    between; as the folded load's numbers span them, they belong to it.
    """
    done = sorted(_spans(snapshot, name))[:-1]
    by_size: dict[int, list[tuple[int, int]]] = {}
    for first, last in done:
        size = 0
        while every ** (size + 1) <= last - first + 1:
            size += 1
        by_size.setdefault(size, []).append((first, last))
    full = [size for size, spans in by_size.items() if len(spans) >= every]
    if not full:
        return []
    spans = by_size[min(full)]
    return [span for span in done if spans[0] <= span <= spans[-1]]


def _fold(table: Destination, now: Snapshot, name: str, spans: list[tuple[int, int]], view: bool) -> bool:
    """Write the loads of ``spans`` as one and publish it in their place; False if they changed meanwhile."""
    spark = table.spark
    loads = [load for span, load in _spans(now, name).items() if span in spans]
    run = new_run(f"{name}-{spans[0][0]}_{spans[-1][1]}")
    path = run_folder(snapshots.store_of(table), run)
    rows = snapshots.rows_of(table, now, loads).drop(RUN)
    rows = rows.hint("rebalance", DAY) if now.by_day else rows.hint("rebalance")
    if TIME in now.schema.names:
        # Row groups of a few days each, whatever the loads were.
        rows = rows.sortWithinPartitions(*([DAY] if now.by_day else []), TIME)
    rows.write.partitionBy(DAY).parquet(path) if now.by_day else rows.write.parquet(path)
    times = [t for x in loads for t in (x.least, x.last) if t is not None]
    known = all(x.least is not None for x in loads)
    folded = Load(
        run, path, sum(x.rows for x in loads), size_of(spark, path),
        min(times) if known else None, max(times) if known else None,
        written_days(spark, path) if now.by_day else None,
    )
    stage(table, now.data, [folded])
    parts = {x.run for x in loads}

    def fold(newest: Snapshot) -> Snapshot | None:
        if newest.data != now.data or not parts <= {x.run for x in newest.loads}:
            return None
        kept = newest.without(loads)
        return replace(kept, loads=(*kept.loads, folded))

    return folded in commit(table, fold, view).loads
