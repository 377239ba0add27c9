"""Reading a table: columns, time range, limit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.functions.timefuncs import SECONDS_PER, in_time_range, to_epoch
from tidetable.operators.shape import key_first
from tidetable.operators.timecols import TIME, parse_dates
from tidetable.sinks import snapshots
from tidetable.sinks.tables import DAY, HIDDEN, LOAD_ID, Destination


def _day_of(seconds: int) -> Column:
    day = dt.date(1970, 1, 1) + dt.timedelta(days=seconds // SECONDS_PER["day"])
    return F.lit(day)


def _newest(spark: SparkSession, name: str, bounds: tuple[int | None, int | None]) -> DataFrame:
    """The newest version of a table, less the loads known to lie outside of a time range."""
    entry = snapshots.metadata(spark, name)
    if entry is None or not entry.properties().contains(snapshots.STORE):
        return spark.table(name)
    identifier = entry.identifier()
    database = identifier.database().get() if identifier.database().isDefined() else spark.catalog.currentDatabase()
    dest = Destination(spark, database, identifier.table())
    now = snapshots.current(dest)
    rows = snapshots.rows_of(dest, now, [x for x in now.loads if x.meets(*bounds)])
    return rows.withColumn(LOAD_ID, snapshots.load_id_of(F.col(snapshots.RUN))) if now.named else rows


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    time_range: tuple[object, object] | None = None,
    limit: int | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    index_col: str | None = None,
    parse: Sequence[str] | Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a table as a lazy frame, of its newest version where it has versions.

    ``columns`` may be expressions; ``time_range`` is half open and tested before they
    are computed, so ``time`` need not be among them. All rows are read unless ``limit``
    is given; without ``order_by`` which rows a limit keeps is not defined. ``index_col`` comes
    first; ``parse`` names date columns, see ``parse_dates``.
    """
    low, high = (None, None) if time_range is None else map(to_epoch, time_range)
    rows = _newest(spark, name, (low, high))
    if time_range is not None:
        rows = rows.where(in_time_range(F.col(TIME), *time_range))
        if DAY in rows.columns:
            if low is not None:
                rows = rows.where(F.col(DAY) >= _day_of(low))
            if high is not None:
                rows = rows.where(F.col(DAY) <= _day_of(high))
    rows = rows.drop(*HIDDEN) if columns is None else rows.selectExpr(*columns)
    if order_by is not None:
        keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
        rows = rows.orderBy(*keys)
    if limit is not None:
        rows = rows.limit(limit)
    return key_first(parse_dates(rows, parse), index_col)
