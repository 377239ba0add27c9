"""Versions of a table: what it holds is one file, and a new version is published in one step.

A table is a view over files that its store keeps. The store's log has a file for each version,
naming the columns and the loads with their files, rows, bytes, days and range of times. A writer
stages files that no version names yet, then creates the next version's file, which fails if
another writer was faster; it then makes its change to that writer's version. ``read_table`` takes
the newest version once. For SQL the view is altered, by one catalog call, to show the runs of the
newest version, so it too shows a whole version at any time, at most one publication behind.

Files that a version no longer names are kept for ``spark.tidetable.graceSeconds`` (a day unless
set), so what was planned on them can finish, and are deleted by a later change. The log needs a
file system whose rename fails if the target exists, as Spark's own streaming checkpoints do.
"""

from __future__ import annotations

import json
import re
import time as clock
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.sinks.storage import changed_at, child_names, create_once, delete_path, read_text
from tidetable.sinks.tables import DAY, LOAD_ID, Destination, column_list

#: The partition column of the files' table: a load's id, a dot, and what tells its runs apart.
RUN = "_run"
STORE = "tidetable.store"
#: In the names of the catalog tables that hold files; these are not for reading.
DATA_MARK = "__data_"
GRACE, GRACE_SETTING = 86_400, "spark.tidetable.graceSeconds"
#: Versions whose files stay in the log at least.
KEPT_VERSIONS = 20


@dataclass(frozen=True)
class Load:
    """The rows of one load: its files, and what is known of them."""

    run: str
    path: str
    rows: int
    bytes: int
    least: int | None = None
    last: int | None = None
    days: tuple[str, ...] | None = None

    @property
    def load_id(self) -> str:
        return self.run.split(".", 1)[0]

    def meets(self, low: int | None, high: int | None) -> bool:
        """Whether rows may have a time in [low, high)."""
        if self.least is None or self.last is None:
            return True
        return (high is None or self.least < high) and (low is None or self.last >= low)


@dataclass(frozen=True)
class Gone:
    """A load's run, or a whole table of files, that no version from ``at`` on names."""

    at: float
    data: str
    run: str | None = None
    path: str | None = None


@dataclass(frozen=True)
class Snapshot:
    """One version of a table."""

    version: int
    data: str
    schema: T.StructType
    named: bool
    by_day: bool
    loads: tuple[Load, ...] = ()
    gone: tuple[Gone, ...] = ()

    def to_json(self) -> str:
        plain = {n: getattr(self, n) for n in ("version", "data", "named", "by_day")}
        parts = {"loads": [asdict(x) for x in self.loads], "gone": [asdict(x) for x in self.gone]}
        return json.dumps(plain | {"schema": self.schema.jsonValue()} | parts)

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        d = json.loads(text)
        loads = [Load(**x | {"days": None if x["days"] is None else tuple(x["days"])}) for x in d.pop("loads")]
        gone = [Gone(**x) for x in d.pop("gone")]
        return cls(**d | {"schema": T.StructType.fromJson(d["schema"]), "loads": tuple(loads), "gone": tuple(gone)})

    def without(self, loads: Sequence[Load]) -> Snapshot:
        """This version less some loads, whose files are kept for the grace period."""
        out = {x.run for x in loads}
        now = clock.time()
        gone = [Gone(now, self.data, x.run, x.path) for x in self.loads if x.run in out]
        return replace(self, loads=tuple(x for x in self.loads if x.run not in out), gone=(*self.gone, *gone))

    def instead(self, load: Load) -> Snapshot:
        """This version with ``load`` in the place of any load of its id."""
        kept = self.without([x for x in self.loads if x.load_id == load.load_id])
        return replace(kept, loads=(*kept.loads, load))


def metadata(spark: SparkSession, name: str):
    """The catalog's entry of a table or view; None for temporary views, paths and unknown names."""
    state = spark._jsparkSession.sessionState()
    try:
        identifier = state.sqlParser().parseTableIdentifier(name)
        if state.catalog().isTempView(identifier) or not state.catalog().tableExists(identifier):
            return None
        return state.catalog().getTableMetadata(identifier)
    except Py4JJavaError:
        return None


def store_of(dest: Destination) -> str | None:
    """The folder of a table's files and versions; None if the table is of another kind or missing."""
    entry = metadata(dest.spark, dest.sql)
    found = None if entry is None else entry.properties().get(STORE)
    return found.get() if found is not None and found.isDefined() else None


def _versions(spark: SparkSession, store: str) -> list[int]:
    names = child_names(spark, f"{store}/log")
    return sorted(int(n.split(".")[0]) for n in names if re.fullmatch(r"\d+\.json", n))


def _log_file(store: str, version: int) -> str:
    return f"{store}/log/{version:012d}.json"


def current(dest: Destination) -> Snapshot | None:
    """The newest version of a table; None if the table is of another kind or missing."""
    store = store_of(dest)
    return None if store is None else _newest(dest.spark, store)


def _newest(spark: SparkSession, store: str) -> Snapshot:
    while True:
        versions = _versions(spark, store)
        text = read_text(spark, _log_file(store, versions[-1]))
        if text is not None:
            return Snapshot.from_json(text)


def new_run(load_id: str) -> str:
    return f"{load_id}.{uuid.uuid4().hex[:12]}"


def new_store(dest: Destination) -> str:
    return f"{dest.folder}/{dest.table}__store_{uuid.uuid4().hex[:12]}"


def run_folder(store: str, run: str) -> str:
    return f"{store}/runs/{run}"


def create_data(dest: Destination, store: str, schema: T.StructType, by_day: bool) -> str:
    """A catalog table for files of these columns, with no rows; its name."""
    data = f"{dest.table}{DATA_MARK}{uuid.uuid4().hex[:12]}"
    keys = [RUN, DAY] if by_day else [RUN]
    columns = column_list(schema, keys)
    dest.spark.sql(
        f"CREATE TABLE {dest.beside(data)} ({columns}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{store}/runs'"
    )
    return data


def _spec(run: str, day: str | None = None) -> str:
    return f"PARTITION (`{RUN}` = '{run}'" + (f", `{DAY}` = '{day}')" if day is not None else ")")


def stage(dest: Destination, data: str, loads: Sequence[Load]) -> None:
    """Let the files' table know the files of loads, which no version names yet."""
    parts = [
        f"{_spec(x.run, day)} LOCATION '{x.path}{'' if day is None else f'/{DAY}={day}'}'"
        for x in loads
        for day in (x.days if x.days is not None else (None,))
    ]
    for at in range(0, len(parts), 500):
        dest.spark.sql(f"ALTER TABLE {dest.beside(data)} ADD IF NOT EXISTS {' '.join(parts[at : at + 500])}")


def view_text(dest: Destination, snapshot: Snapshot) -> str:
    """The query that shows a version."""
    columns = [f"`{f.name}`" for f in snapshot.schema.fields]
    if snapshot.named:
        columns.append(f"substring_index(`{RUN}`, '.', 1) AS `{LOAD_ID}`")
    if snapshot.by_day:
        columns.append(f"`{DAY}`")
    runs = ", ".join(f"'{x.run}'" for x in snapshot.loads)
    shown = f"`{RUN}` IN ({runs})" if runs else "false"
    return f"SELECT {', '.join(columns)} FROM {dest.beside(snapshot.data)} WHERE {shown}"


def create(dest: Destination, store: str, snapshot: Snapshot) -> None:
    """Make ``dest`` a table that shows ``snapshot``; it appears by one catalog call.

    A table of another kind under that name is renamed away first and dropped last.
    """
    spark = dest.spark
    create_once(spark, _log_file(store, snapshot.version), snapshot.to_json())
    old = dest.sibling(f"__old_{uuid.uuid4().hex[:12]}") if dest.exists else None
    if old is not None:
        spark.sql(f"ALTER TABLE {dest.sql} RENAME TO {old.sql}")
    try:
        spark.sql(f"CREATE VIEW {dest.sql} TBLPROPERTIES ('{STORE}' = '{store}') AS {view_text(dest, snapshot)}")
    except BaseException:
        if old is not None:
            spark.sql(f"ALTER TABLE {old.sql} RENAME TO {dest.sql}")
        raise
    if old is not None:
        spark.sql(f"DROP TABLE IF EXISTS {old.sql}")


def show(dest: Destination, snapshot: Snapshot) -> None:
    """Let the view show a version, and a newer one if there is one by then."""
    store = store_of(dest)
    while True:
        dest.spark.sql(f"ALTER VIEW {dest.sql} AS {view_text(dest, snapshot)}")
        newest = _versions(dest.spark, store)[-1]
        if newest == snapshot.version:
            return
        snapshot = _newest(dest.spark, store)


def commit(
    dest: Destination,
    change: Callable[[Snapshot], Snapshot | None],
    view: bool = True,
    newest: Snapshot | None = None,
) -> Snapshot:
    """Publish the version that ``change`` makes of the newest one (``newest``, if it is known); returns it.

    If another writer is faster, ``change`` is asked again with that writer's version. If it gives
    None, there is nothing to publish. Without ``view``, SQL sees the version at the next publication
    with one, or after :func:`show`.
    """
    spark, store = dest.spark, store_of(dest)
    while True:
        before, newest = newest or _newest(spark, store), None
        after = change(before)
        if after is None:
            return before
        after = replace(after, version=before.version + 1)
        if create_once(spark, _log_file(store, after.version), after.to_json()):
            break
    if view:
        show(dest, after)
    if after.version % KEPT_VERSIONS == 0:
        for version in _versions(spark, store):
            if version <= after.version - KEPT_VERSIONS:
                delete_path(spark, _log_file(store, version))
    return after


def grace_seconds(spark: SparkSession) -> float:
    return float(spark.conf.get(GRACE_SETTING, str(GRACE)))


def sweep(dest: Destination, snapshot: Snapshot | None = None) -> None:
    """Delete the files that no version has named for longer than the grace period."""
    spark = dest.spark
    before = clock.time() - grace_seconds(spark)
    expired: list[Gone] = []

    def forget(now: Snapshot) -> Snapshot | None:
        expired[:] = [x for x in now.gone if x.at <= before]
        return replace(now, gone=tuple(x for x in now.gone if x.at > before)) if expired else None

    snapshot = snapshot or current(dest)
    if snapshot is None or not any(x.at <= before for x in snapshot.gone):
        return
    snapshot = commit(dest, forget, view=False)
    tables = {x.data for x in expired if x.run is None}
    for data in tables:
        spark.sql(f"DROP TABLE IF EXISTS {dest.beside(data)}")
    by_data: dict[str, list[str]] = {}
    for x in expired:
        if x.run is not None and x.data not in tables:
            by_data.setdefault(x.data, []).append(x.run)
    for data, runs in by_data.items():
        if metadata(spark, dest.beside(data)) is not None:
            for at in range(0, len(runs), 500):
                specs = ", ".join(map(_spec, runs[at : at + 500]))
                spark.sql(f"ALTER TABLE {dest.beside(data)} DROP IF EXISTS {specs}")
    family = [d for d in (dest, dest.rejects, dest.loaded) if d is not None]
    held = [x.path for d in family if (s := current(d)) is not None for x in s.loads]
    held += [x.path for d in family if (s := current(d)) is not None for x in s.gone if x.path is not None]
    for x in expired:
        if x.path is not None:
            folder = re.sub(r"(/runs/[^/]+).*", r"\1", x.path)
            free = not any(p == folder or p.startswith(f"{folder}/") for p in held)
            delete_path(spark, folder if free else x.path)


def vacuum(dest: Destination, older_than: float = GRACE) -> list[str]:
    """Delete the runs that lost writers left in a table's store, untouched for so many seconds; their names."""
    spark, store = dest.spark, store_of(dest)
    if store is None:
        return []
    family = [d for d in (dest, dest.rejects, dest.loaded) if d is not None]
    now = [s for d in family if (s := current(d)) is not None]
    named = [x.path for s in now for x in (*s.loads, *s.gone) if x.path is not None]
    lost = []
    for name in child_names(spark, f"{store}/runs"):
        folder = run_folder(store, name)
        unused = not any(p == folder or p.startswith(f"{folder}/") for p in named)
        if unused and clock.time() - changed_at(spark, folder) >= older_than:
            delete_path(spark, folder)
            lost.append(name)
    for s in now:
        if lost and s.data.startswith(f"{dest.table}{DATA_MARK}"):
            gone = ", ".join(_spec(name) for name in lost)
            spark.sql(f"ALTER TABLE {dest.beside(s.data)} DROP IF EXISTS {gone}")
    return lost


def drop(dest: Destination) -> None:
    """Drop a table with all its versions and files."""
    spark, store = dest.spark, store_of(dest)
    snapshot = _newest(spark, store)
    spark.sql(f"DROP VIEW IF EXISTS {dest.sql}")
    for data in {snapshot.data, *(x.data for x in snapshot.gone)}:
        spark.sql(f"DROP TABLE IF EXISTS {dest.beside(data)}")
    delete_path(spark, store)


def rows_of(dest: Destination, snapshot: Snapshot, loads: Sequence[Load] | None = None) -> DataFrame:
    """The rows of a version, or of some of its loads, with the columns that tell run and day."""
    spark = dest.spark
    rows = spark.table(dest.beside(snapshot.data))
    if [f.name for f in snapshot.schema.fields if f.name not in rows.columns]:
        # Another session added columns.
        spark.catalog.refreshTable(dest.beside(snapshot.data))
        rows = spark.table(dest.beside(snapshot.data))
    wanted = [x.run for x in (snapshot.loads if loads is None else loads)]
    kept = [F.col(f"`{f.name}`") for f in snapshot.schema.fields] + [F.col(c) for c in (RUN, DAY) if c in rows.columns]
    return rows.where(F.col(RUN).isin(wanted) if wanted else F.lit(False)).select(*kept)


def load_id_of(run: Column) -> Column:
    return F.substring_index(run, ".", 1)
