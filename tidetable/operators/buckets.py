"""Grouping by time period, frequency counts and gap-filled resampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.functions.timefuncs import (
    SECONDS_PER,
    as_epoch,
    check_unit,
    day_start,
    epoch_trunc,
    in_time_range,
    is_datetime,
    utc_day,
)
from tidetable.session import written

# Aggregates with the value an empty period has; NULL unless listed.
AGGREGATES = {"min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg, "count": F.count}
EMPTY_VALUE = {"sum": 0, "count": 0}


def _aggregates(aggs: Mapping[str, tuple[str, str] | Column]) -> list[Column]:
    out = []
    for name, agg in aggs.items():
        if isinstance(agg, Column):
            out.append(agg.alias(name))
            continue
        how, column = agg
        if how not in AGGREGATES:
            raise ValueError(f"unknown aggregate {how!r}; use one of {', '.join(AGGREGATES)}")
        value = F.lit(1) if column == "*" else F.col(f"`{column}`")
        out.append(AGGREGATES[how](value).alias(name))
    return out


def aggregate(
    df: DataFrame, by: Sequence[str], aggs: Mapping[str, tuple[str, str] | Column]
) -> DataFrame:
    """Group by columns; ``aggs`` maps a result name to ``(function, column)`` (A1-A3)."""
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*_aggregates(aggs))


def bucket_aggregate(
    df: DataFrame,
    unit: str,
    aggs: Mapping[str, tuple[str, str] | Column],
    by: Sequence[str] = (),
    time_range: tuple[object, object] | None = None,
    tz: str | None = None,
    time: str = "time",
) -> DataFrame:
    """Aggregate per time period, optionally per further keys (A4).

    ``time`` holds unix seconds and comes back as the start of its period. The range is
    tested on the raw column so it reaches the scan.
    """
    seconds = F.col(f"`{time}`")
    if time_range is not None:
        df = df.where(in_time_range(seconds, *time_range))
    keys = [epoch_trunc(unit, seconds, tz).alias(time), *[F.col(f"`{c}`") for c in by]]
    return df.groupBy(*keys).agg(*_aggregates(aggs))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Frequency of each value, most frequent first, NULL left out (A5)."""
    value = F.col(f"`{column}`")
    return (
        df.where(value.isNotNull())
        .groupBy(value)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(f"`{name}`").desc(), value)
    )


def _step_of(unit: str, seconds: Column) -> Column:
    """Number of the period holding ``seconds``; consecutive periods differ by one."""
    if unit in SECONDS_PER:
        width = SECONDS_PER[unit]
    elif unit == "week":
        width = 7 * SECONDS_PER["day"]
        seconds = seconds + F.lit(3 * SECONDS_PER["day"])  # the epoch was a Thursday
    else:
        day = utc_day(seconds)
        months = F.year(day).cast("bigint") * F.lit(12) + F.month(day) - F.lit(1)
        width = {"month": 1, "quarter": 3, "year": 12}[unit]
        return F.call_function("div", months, F.lit(width).cast("bigint"))
    wide = F.lit(width).cast("bigint")
    return F.call_function("div", seconds - F.pmod(seconds, wide), wide)


def _start_of(unit: str, step: Column) -> Column:
    """Unix seconds at which period number ``step`` starts."""
    if unit in SECONDS_PER:
        return step * F.lit(SECONDS_PER[unit]).cast("bigint")
    if unit == "week":
        return step * F.lit(7 * SECONDS_PER["day"]).cast("bigint") - F.lit(3 * SECONDS_PER["day"])
    months = step * F.lit({"month": 1, "quarter": 3, "year": 12}[unit])
    year = F.call_function("div", months, F.lit(12).cast("bigint")).cast("int")
    month = (F.pmod(months, F.lit(12)) + F.lit(1)).cast("int")
    return day_start(F.make_date(year, month, F.lit(1)))


def resample(
    df: DataFrame,
    unit: str,
    aggs: Mapping[str, tuple[str, str]],
    time: str = "time",
    label: str = "start",
) -> DataFrame:
    """Aggregate per period over the whole span, empty periods included.

    ``time`` may hold unix seconds or timestamps and comes back as unix seconds: the
    period's first second, or with ``label="end"`` the start of its last day (for units
    shorter than a day: the start itself). Empty periods hold NULL, but 0 for sums and
    counts.

    The grouped rows are written to the shared folder at once, so the input is read one
    time; the periods between the first and the last then come from a range of known size.
    """
    unit = check_unit(unit)
    if label not in ("start", "end"):
        raise ValueError("label must be 'start' or 'end'")
    seconds = F.col(f"`{time}`")
    if is_datetime(df.schema[time].dataType):
        seconds = as_epoch(seconds, df.schema[time].dataType)
    step = "_step"
    filled = (
        df.withColumn(step, _step_of(unit, seconds))
        .where(F.col(step).isNotNull())
        .groupBy(step)
        .agg(*_aggregates(aggs))
    )
    filled = written(filled, "resample")
    first, last = filled.agg(F.min(step), F.max(step)).first()
    span = (0, 0) if first is None else (first, last + 1)
    spine = df.sparkSession.range(*span).withColumnRenamed("id", step)
    start = _start_of(unit, F.col(step))
    if label == "end" and unit not in ("second", "minute", "hour"):
        start = _start_of(unit, F.col(step) + F.lit(1)) - F.lit(SECONDS_PER["day"])
    values = []
    for name, (how, _) in aggs.items():
        value = F.col(f"`{name}`")
        if how in EMPTY_VALUE:
            value = F.coalesce(value, F.lit(EMPTY_VALUE[how]).cast(filled.schema[name].dataType))
        values.append(value.alias(name))
    return spine.join(filled, step, "left").select(start.cast("bigint").alias(time), *values)
