"""Changing the types of stored columns."""

from __future__ import annotations

import time as clock
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.errors import LoadError
from tidetable.operators.declared import converted, declared_type
from tidetable.operators.timecols import TIME
from tidetable.session import sql_settings
from tidetable.sinks import snapshots
from tidetable.sinks.sessions import nullable, written_days
from tidetable.sinks.snapshots import RUN, Gone, Load, Snapshot
from tidetable.sinks.storage import child_names, delete_path, size_of
from tidetable.sinks.tables import DAY, Destination, staging_for, swap_in

DISPLAY_NAME = "display_name"


def recast_columns(
    spark: SparkSession, table_name: str, changes: Sequence[tuple[str, str] | tuple[str, str, str]]
) -> None:
    """Rewrite a table with ``(column, type[, display name])`` changes applied.

    A value that does not read as the new type raises and leaves the table as it was. The
    display name is kept as the column's comment. All loads are rewritten under new names, then
    published together as the next version.
    """
    dest = Destination.of(spark, table_name)
    now = snapshots.current(dest)
    wanted = {column: (declared_type(kind), *rest) for column, kind, *rest in changes}
    table = spark.table(dest.sql) if now is None else snapshots.rows_of(dest, now)
    names = dest.schema.names if now is None else now.schema.names
    unknown = [c for c in wanted if c not in names]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    columns = []
    for field in table.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in wanted:
            kind, *alias = wanted[field.name]
            notes = {"comment": alias[0], DISPLAY_NAME: alias[0]} if alias else dict(field.metadata)
            column = converted(column, field.dataType, kind).alias(field.name, metadata=notes)
        columns.append(column)
    recast = table.select(*columns)
    if now is None:
        _recast_plain(dest, recast)
    else:
        _recast_versions(dest, now, recast)


def _recast_plain(dest: Destination, recast: DataFrame) -> None:
    """A table that has no versions is written beside the old one and swapped in."""
    spark, staged = dest.spark, staging_for(dest)
    try:
        recast.write.format("parquet").saveAsTable(staged.sql)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged.sql}")
        raise
    swap_in(dest, staged)


def _recast_versions(dest: Destination, now: Snapshot, recast: DataFrame) -> None:
    spark, store, mark = dest.spark, snapshots.store_of(dest), uuid.uuid4().hex[:12]
    path = snapshots.run_folder(store, f"recast.{mark}")
    keys = [RUN, DAY] if now.by_day else [RUN]
    stored = nullable(T.StructType([f for f in recast.schema if f.name not in keys]))
    renamed = recast.withColumn(RUN, F.concat(F.col(RUN), F.lit(f".{mark}")))
    try:
        with sql_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "8"}):
            renamed.write.partitionBy(*keys).parquet(path)
    except BaseException:
        delete_path(spark, path)
        raise
    timed = TIME in stored.names and isinstance(stored[TIME].dataType, T.LongType)
    written = set(child_names(spark, path))
    loads = []
    for load in now.loads:
        run = f"{load.run}.{mark}"
        if f"{RUN}={run}" in written:
            at = f"{path}/{RUN}={run}"
            times = (load.least, load.last) if timed else (None, None)
            days = written_days(spark, at) if now.by_day else None
            loads.append(Load(run, at, load.rows, size_of(spark, at), *times, days))
    data = snapshots.create_data(dest, store, stored, now.by_day)
    snapshots.stage(dest, data, loads)

    def changed(newest: Snapshot) -> Snapshot:
        if newest.data != now.data or newest.loads != now.loads:
            raise LoadError(f"{dest.sql} was changed while its columns were recast; run it again")
        emptied = newest.without(newest.loads)
        gone = (*emptied.gone, Gone(clock.time(), newest.data))
        return replace(newest, data=data, schema=stored, loads=tuple(loads), gone=gone)

    snapshots.commit(dest, changed)
    snapshots.sweep(dest)
