"""Building, parsing and formatting time columns."""

from __future__ import annotations

import time as clock
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.functions.patterns import parse_pattern, strftime
from tidetable.functions.timefuncs import as_epoch, as_instant, is_datetime, wall_clock

TIME = "time"
TIME_TEXT = "_time_text"


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def build_time(
    df: DataFrame,
    time_col: str | None = None,
    time_key: str | None = None,
    time_format: str | None = None,
    now: int | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Give ``df`` a ``time`` column of unix seconds (C4).

    ``time_col`` is renamed to ``time`` and converted; ``time_key`` names a datetime key
    column that stays and is copied; with neither, one constant (``now``, else the
    driver's clock) is used for all rows, so a retried task writes the same value.
    ``lenient`` turns malformed text into NULL and keeps the text in a column
    ``_time_text``, for a validated load to set such rows aside.
    """
    if time_col is not None and time_key is not None:
        raise ValueError("give time_col or time_key, not both")
    if any(c.lower() == TIME and c != time_col for c in df.columns):
        raise ValueError("the frame already has a 'time' column")
    for name in (time_col, time_key):
        if name is not None and name not in df.columns:
            raise ValueError(f"no such column: {name!r}")
    pattern = parse_pattern(time_format) if time_format else None
    if time_col is not None:
        kind = df.schema[time_col].dataType
        seconds = as_epoch(_col(time_col), kind, pattern, lenient)
        if lenient and isinstance(kind, T.StringType):
            df = df.withColumn(TIME_TEXT, _col(time_col))
        return df.withColumn(time_col, seconds).withColumnRenamed(time_col, TIME)
    if time_key is not None:
        kind = df.schema[time_key].dataType
        if not is_datetime(kind):
            raise TypeError(f"key column {time_key!r} must hold datetimes, not {kind.simpleString()}")
        return df.withColumn(TIME, as_epoch(_col(time_key), kind))
    constant = int(clock.time()) if now is None else int(now)
    return df.withColumn(TIME, F.lit(constant).cast("bigint"))


def format_dates(df: DataFrame, date_format: str | None) -> DataFrame:
    """Write every datetime column as text in a strftime format."""
    if date_format is None:
        return df
    changed = {
        f.name: strftime(_col(f.name).cast("timestamp"), date_format)
        for f in df.schema.fields
        if is_datetime(f.dataType)
    }
    return df.withColumns(changed) if changed else df


def _from_number(column: Column, unit: str) -> Column:
    whole = column.cast("bigint")
    if unit == "D":
        return F.timestamp_seconds(column * F.lit(86400))
    if unit == "s":
        return F.timestamp_seconds(column)
    if unit == "ms":
        # Scaled first, so that the fraction of a millisecond stays.
        return F.timestamp_micros(F.floor(column * F.lit(1000)).cast("bigint"))
    if unit == "us":
        return F.timestamp_micros(F.floor(column).cast("bigint"))
    if unit == "ns":
        # Integer division only: going through a double would round the microseconds.
        thousand = F.lit(1000).cast("bigint")
        floored = whole - F.pmod(whole, thousand)
        return F.timestamp_micros(F.call_function("div", floored, thousand))
    raise ValueError(f"unknown time unit {unit!r}; use D, s, ms, us or ns")


def parse_dates(df: DataFrame, spec: Sequence[str] | Mapping[str, str] | None) -> DataFrame:
    """Parse columns into timestamps, in UTC where they name no zone, whatever the session's zone.

    A list parses text in the usual forms. A mapping gives a strftime format for a text
    column, or a unit (``D s ms us ns``) for a number column. Malformed text raises.
    """
    if spec is None:
        return df
    changed = {}
    for name in spec:
        kind = df.schema[name].dataType
        column = _col(name)
        if is_datetime(kind):
            changed[name] = as_instant(column, kind)
        elif not isinstance(spec, Mapping):
            # A bare number is read as nanoseconds since the epoch.
            text = isinstance(kind, T.StringType)
            changed[name] = as_instant(column, kind) if text else _from_number(column, "ns")
        elif isinstance(kind, T.StringType):
            changed[name] = as_instant(column, kind, parse_pattern(spec[name]))
        else:
            changed[name] = _from_number(column, spec[name])
    return df.withColumns(changed)


def convert_time(df: DataFrame) -> DataFrame:
    """Turn a column named ``time`` into a timestamp: text is parsed, numbers are unix seconds."""
    if TIME not in df.columns:
        return df
    kind = df.schema[TIME].dataType
    if is_datetime(kind) or isinstance(kind, T.StringType):
        stamp = as_instant(_col(TIME), kind)
    else:
        stamp = F.timestamp_seconds(_col(TIME))
    return df.withColumn(TIME, stamp)


def shift_timezone(df: DataFrame, tz: str | None, column: str = TIME) -> DataFrame:
    """Show a timestamp column as the wall-clock time of ``tz``, without a zone of its own.

    The result is a timestamp without zone, so it is the same in any session.
    """
    if tz is None:
        return df
    return df.withColumn(column, wall_clock(as_instant(_col(column), df.schema[column].dataType), tz))
