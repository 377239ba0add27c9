"""Loading frames into tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.errors import TableExistsError
from tidetable.operators.coerce import coerce
from tidetable.operators.declared import conform
from tidetable.operators.names import normalise_name, normalise_names
from tidetable.operators.rowindex import add_row_index
from tidetable.operators.textguess import guess_text_types
from tidetable.operators.timecols import TIME, build_time, format_dates
from tidetable.session import discard
from tidetable.sinks.chunks import CHUNK_ROWS, MAX_CHUNKS, chunked, rows_per_file
from tidetable.sinks.sessions import check_load_id, run_load
from tidetable.sinks.snapshots import current
from tidetable.sinks.tables import DAY, HIDDEN, Destination, policy

__all__ = ["CHUNK_ROWS", "MAX_CHUNKS", "LoadReport", "from_pandas", "load_table", "rows_per_file", "store_frame"]


@dataclass(frozen=True)
class LoadReport:
    """What a load did. ``load_id`` is set for load sessions, counts unless skipped."""

    table: str
    skipped: bool = False
    load_id: str | None = None
    total: int = 0
    valid: int = 0

    @property
    def rejected(self) -> int:
        return self.total - self.valid


def from_pandas(
    spark: SparkSession,
    frame: pd.DataFrame,
    index: bool = False,
    index_label: str | Sequence[str] | None = None,
) -> DataFrame:
    """Spark frame from a pandas one; ``index=True`` turns index levels into columns."""
    if index:
        levels = frame.index.nlevels
        frame = frame.reset_index(names=index_label)
        frame = frame[[*frame.columns[levels:], *frame.columns[:levels]]]
    frame = frame.rename(columns=str)
    return spark.createDataFrame(_complex_as_text(frame))


def _complex_as_text(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns of complex numbers as text, since Spark has no such type."""
    changed = {c: frame[c].map(str, na_action="ignore") for c in frame.columns if frame[c].dtype.kind == "c"}
    return frame.assign(**changed)


def prepare(
    df: DataFrame,
    time_col: str | None = None,
    add_time: bool = True,
    keep_arrays: bool = False,
    keep_bool: bool = False,
    infer_text_types: bool = False,
    declared: T.StructType | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Names, ``time`` and types as they will be stored; one projection, no shuffle."""
    frame = normalise_names(df)
    clash = [c for c in frame.columns if c in HIDDEN]
    if clash:
        raise ValueError(f"reserved column name: {', '.join(clash)}")
    source = TIME if time_col is None else normalise_name(time_col)
    if time_col is not None or TIME in frame.columns:
        frame = build_time(frame, source, lenient=lenient)
    elif add_time:
        frame = build_time(frame)
    if infer_text_types:
        frame = guess_text_types(frame)
    kept = [f.name for f in declared or () if isinstance(f.dataType, (T.ArrayType, T.BooleanType))]
    # Text has no way back to these, so they are converted from what they are.
    nested = (T.BinaryType, T.MapType, T.StructType)
    as_is = [f.name for f in declared or () if isinstance(f.dataType, nested)]
    return coerce(frame, keep_arrays, keep_bool, kept, as_is)


def load_table(
    df: DataFrame | pd.DataFrame,
    name: str,
    if_exists: str = "error",
    *,
    spark: SparkSession | None = None,
    time_col: str | None = None,
    add_time: bool = True,
    schema: T.StructType | None = None,
    evolve: bool = False,
    validate: bool = False,
    load_id: str | None = None,
    allow_empty: bool = False,
    keep_arrays: bool = False,
    keep_bool: bool = False,
    infer_text_types: bool = False,
    chunk_rows: int | None = None,
    sort_by_time: bool = False,
    day_partitions: bool = False,
    publish: bool = True,
    prepared: bool = False,
) -> LoadReport:
    """Load ``df`` into table ``name`` (``"db.t"``, or ``"t"`` in the current database).

    ``if_exists``: ``error``/``fail`` raises, ``overwrite``/``replace`` replaces rows and
    schema, ``append`` inserts by column name (creating the table if needed), ``ignore``
    does nothing. A frame without ``time`` gets the current unix time.

    ``schema`` declares the target columns. ``validate`` or ``load_id`` runs a load
    session: rows that do not fit are kept aside in ``<name>__rejects``, a load without
    valid rows raises and publishes nothing, and repeating a ``load_id`` replaces its
    rows. ``evolve`` lets an append add columns.

    Layout: ``chunk_rows`` caps rows per file (the cap grows with the data),
    ``sort_by_time`` sorts inside each task so that time ranges skip row groups,
    ``day_partitions`` files rows under a hidden day column that time ranges prune (an append
    follows the table). Without ``publish`` ``read_table`` sees the load at once, SQL with the
    table's next publication. A ``prepared`` frame comes from :func:`prepare` as it is to be stored.
    """
    mode = policy(if_exists)
    if isinstance(df, pd.DataFrame):
        if spark is None:
            spark = SparkSession.getActiveSession()
        df = from_pandas(spark, df)
    spark = df.sparkSession
    dest = Destination.of(spark, name)
    if load_id is not None:
        check_load_id(load_id)
    now = current(dest)
    exists = now is not None or dest.exists
    if exists and mode == "error":
        raise TableExistsError(f"table {dest.sql} already exists")
    if exists and mode == "ignore":
        return LoadReport(dest.sql, skipped=True)
    mode = mode if exists else "create"
    appending = mode == "append"
    in_session = validate or load_id is not None or (appending and now is not None and now.named)
    if appending:
        by_day = now.by_day if now is not None else DAY in dest.partition_columns
    else:
        by_day = day_partitions

    target = None if not appending else dest.schema if now is None else now.schema
    frame = df
    if not prepared:
        frame = prepare(
            df, time_col, add_time, keep_arrays, keep_bool, infer_text_types, schema or target, lenient=in_session
        )
    if schema is not None and not in_session:
        frame = conform(frame, schema, evolve)
    settings, counted = {}, frame
    if chunk_rows is not None:
        frame, settings, counted = chunked(frame, chunk_rows)
    try:
        load_id, total, valid = run_load(
            frame, dest, mode, in_session, now, schema, evolve, load_id, allow_empty, settings, by_day, sort_by_time, publish
        )
    finally:
        discard(counted)
    return LoadReport(dest.sql, load_id=load_id if in_session else None, total=total, valid=valid)


def store_frame(
    df: DataFrame | pd.DataFrame,
    name: str,
    if_exists: str = "fail",
    *,
    spark: SparkSession | None = None,
    time_col: str | None = None,
    time_key: str | None = None,
    index: bool = False,
    index_label: str | Sequence[str] | None = None,
    order_by: Sequence[str] | str | None = None,
    date_format: str | None = None,
    **options: object,
) -> LoadReport:
    """Load with explicit rules for ``time``, the row index and dates.

    ``time_col`` is renamed to ``time``; ``time_key`` names a datetime key column, or a level
    of a pandas frame's index, that is copied into it; with neither, the current time is used and a ``time`` column already
    there is an error. ``index`` adds a row index (following ``order_by``; for a pandas
    frame: its own index). ``date_format`` writes the datetime columns as text.
    """
    policy(if_exists)
    if isinstance(df, pd.DataFrame):
        if spark is None:
            spark = SparkSession.getActiveSession()
        level = time_key in df.index.names and time_key not in df.columns
        df = from_pandas(spark, _with_level(df, time_key, index) if level else df, index, index_label)
        if level and not index:
            # The level gives the time; it is not stored as a column of its own.
            frame = build_time(normalise_names(df), None, normalise_name(time_key))
            frame = format_dates(frame.drop(normalise_name(time_key)), date_format)
            return load_table(frame, name, if_exists, **options)
        index = False
    frame = normalise_names(df)
    time_col, time_key = (None if n is None else normalise_name(n) for n in (time_col, time_key))
    frame = build_time(frame, time_col, time_key)
    if index:
        label = index_label if isinstance(index_label, str) else (index_label or ["index"])[0]
        keys = [order_by] if isinstance(order_by, str) else order_by
        keys = None if keys is None else [normalise_name(k) if isinstance(k, str) else k for k in keys]
        frame = add_row_index(frame, keys, label)
    frame = format_dates(frame, date_format)
    return load_table(frame, name, if_exists, **options)


def _with_level(frame: pd.DataFrame, level: str, index: bool) -> pd.DataFrame:
    """The frame with an index level as a column, unless the whole index becomes columns anyway."""
    return frame if index else frame.reset_index(level=level)
