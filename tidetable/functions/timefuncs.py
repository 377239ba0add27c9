"""Time arithmetic on unix seconds, as plain column expressions.

Everything here folds to comparisons and built-in functions, so filters reach the
parquet scan and aggregations stay inside generated code. Times without a zone are UTC,
whatever zone the session is set to.
"""

from __future__ import annotations

import datetime as dt
import numbers
import re
import zoneinfo

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
CALENDAR_UNITS = ("week", "month", "quarter", "year")


def check_unit(unit: str) -> str:
    """Lower-case ``unit`` after making sure it can be truncated to."""
    name = unit.lower()
    if name not in SECONDS_PER and name not in CALENDAR_UNITS:
        raise ValueError(f"unknown time unit: {unit!r}")
    return name


def check_timezone(tz: str) -> str:
    """Return ``tz`` if it names a time zone, else raise ``ValueError``."""
    try:
        zoneinfo.ZoneInfo(tz)
    except (zoneinfo.ZoneInfoNotFoundError, OSError, ValueError) as exc:
        raise ValueError(f"unknown time zone: {tz!r}") from exc
    return tz


def to_epoch(value: object) -> int | None:
    """Convert a time bound to unix seconds (F2).

    ``None`` stays open, integers are unix seconds already, text / dates / datetimes are
    read as UTC unless they carry an offset. Fractions of a second are cut off.
    """
    if value is None:
        return None
    if isinstance(value, bool):
        raise ValueError(f"not a time value: {value!r}")
    if isinstance(value, numbers.Integral):
        return int(value)
    if not isinstance(value, (str, dt.date)):
        raise ValueError(f"not a time value: {value!r}")
    stamp = pd.Timestamp(value)
    if stamp is pd.NaT:
        raise ValueError(f"not a time value: {value!r}")
    if stamp.tzinfo is None:
        stamp = stamp.tz_localize("UTC")
    return int(stamp.floor("s").timestamp())


def in_time_range(time: Column, start: object = None, end: object = None) -> Column:
    """Half-open range test ``start <= time < end`` with optional bounds."""
    low, high = to_epoch(start), to_epoch(end)
    test = None
    if low is not None:
        test = time >= F.lit(low).cast("bigint")
    if high is not None:
        below = time < F.lit(high).cast("bigint")
        test = below if test is None else test & below
    return F.lit(True) if test is None else test


def utc_day(time: Column) -> Column:
    """The UTC date of unix seconds."""
    width = F.lit(SECONDS_PER["day"]).cast("bigint")
    return F.date_from_unix_date(F.call_function("div", time - F.pmod(time, width), width).cast("int"))


def day_start(day: Column) -> Column:
    """Unix seconds of a date's first second in UTC."""
    return F.unix_date(day).cast("bigint") * F.lit(SECONDS_PER["day"])


def ntz_epoch(stamp: Column) -> Column:
    """Unix seconds of a timestamp without zone, read as UTC and floored."""
    return (
        day_start(stamp.cast("date"))
        + F.hour(stamp) * F.lit(SECONDS_PER["hour"])
        + F.minute(stamp) * F.lit(SECONDS_PER["minute"])
        + F.second(stamp)
    )


def ntz_instant(stamp: Column) -> Column:
    """The instant of a timestamp without zone, read as UTC whatever the session's zone is."""
    million = F.lit(1_000_000).cast("bigint")
    fraction = F.pmod((F.date_part(F.lit("SECOND"), stamp) * million).cast("bigint"), million)
    return F.timestamp_micros(ntz_epoch(stamp) * million + fraction)


def wall_clock(stamp: Column, tz: str) -> Column:
    """What the clocks of ``tz`` show at an instant, as a timestamp without zone."""
    shifted = F.unix_micros(F.from_utc_timestamp(stamp, F.lit(check_timezone(tz))))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    million = F.lit(1_000_000).cast("bigint")
    seconds = F.call_function("div", shifted - F.pmod(shifted, million), million)
    days = F.call_function("div", seconds - F.pmod(seconds, F.lit(86_400)), F.lit(86_400).cast("bigint"))
    rest = (F.pmod(shifted, F.lit(86_400_000_000)).cast("decimal(18,6)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return start + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), rest)


def epoch_trunc(unit: str, time: Column, tz: str | None = None) -> Column:
    """Start of the period holding ``time``, as unix seconds."""
    name = check_unit(unit)
    if tz is None and name in SECONDS_PER:
        width = SECONDS_PER[name]
        return time if width == 1 else time - F.pmod(time, F.lit(width).cast("bigint"))
    if tz is None:
        return day_start(F.trunc(utc_day(time), name))
    zone = F.lit(check_timezone(tz))
    local = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(time), zone))
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(epoch_trunc(name, local)), zone))


def epoch_format(time: Column, pattern: str, tz: str | None = None) -> Column:
    """Format unix seconds with a Spark datetime pattern; literals may be part of it.

    The wall clock shown is that of UTC or ``tz``. Spark formats in the session's zone, so
    an hour that the session's zone skips is shown as the next one there.
    """
    stamp = F.timestamp_seconds(time)
    if tz is not None:
        stamp = F.from_utc_timestamp(stamp, F.lit(check_timezone(tz)))
    return F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), pattern)


def is_datetime(kind: T.DataType) -> bool:
    """Whether a column of this type holds points in time."""
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))


# A zone at the end of a text, after its time of day; the pattern letters that stand for one.
_ZONE = r":[0-9.]+ ?([Zz]|[+-][0-9:]+|[A-Za-z]+[A-Za-z0-9/_+:-]*)$"
_ZONE_LETTERS = "VzOXxZ"


def _text_instant(column: Column, pattern: str | None, lenient: bool) -> Column:
    """The instant that a text names, in UTC where it names no zone."""
    if pattern is None:
        with_zone = F.try_to_timestamp(column) if lenient else F.to_timestamp(column)
        without = column.try_cast("timestamp_ntz") if lenient else column.cast("timestamp_ntz")
        return F.when(column.rlike(_ZONE), with_zone).otherwise(ntz_instant(without))
    letters = re.sub(r"'[^']*'", "", pattern)
    if not any(c in letters for c in _ZONE_LETTERS):
        column, pattern = F.concat(column, F.lit(" +0000")), f"{pattern} xx"
    return F.try_to_timestamp(column, F.lit(pattern)) if lenient else F.to_timestamp(column, pattern)


def as_instant(column: Column, kind: T.DataType, parse_pattern: str | None = None) -> Column:
    """A text or date column as a timestamp; times without a zone are UTC. Malformed text raises."""
    if isinstance(kind, T.StringType):
        return _text_instant(column, parse_pattern, False)
    if isinstance(kind, T.TimestampNTZType):
        return ntz_instant(column)
    if isinstance(kind, T.DateType):
        return F.timestamp_seconds(day_start(column))
    return column.cast("timestamp")


def as_epoch(
    column: Column, kind: T.DataType, parse_pattern: str | None = None, lenient: bool = False
) -> Column:
    """Turn any kind of time column into unix seconds, flooring fractions (C4).

    Malformed text raises, or becomes NULL if ``lenient``. Text, dates and timestamps without
    a zone are read as UTC.
    """
    if isinstance(kind, T.StringType):
        return F.unix_seconds(_text_instant(column, parse_pattern, lenient))
    if isinstance(kind, T.TimestampNTZType):
        return ntz_epoch(column)
    if isinstance(kind, T.DateType):
        return day_start(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.floor(F.nanvl(column.cast("double"), F.lit(None).cast("double"))).cast("bigint")
    if isinstance(kind, T.DecimalType):
        return F.floor(column).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    raise TypeError(f"cannot use a {kind.simpleString()} column as time")
