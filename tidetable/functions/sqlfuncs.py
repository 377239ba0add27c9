"""The time functions for SQL text, as SQL-body functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

_ZONE = r":[0-9.]+ ?([Zz]|[+-][0-9:]+|[A-Za-z]+[A-Za-z0-9/_+:-]*)$"


def _bound(name: str) -> str:
    """Unix seconds of a time given as text; without a zone it is UTC."""
    clock = f"CAST({name} AS TIMESTAMP_NTZ)"
    return (
        f"CASE WHEN {name} RLIKE r'{_ZONE}' THEN unix_seconds(CAST({name} AS TIMESTAMP)) "
        f"ELSE unix_date(CAST({clock} AS DATE)) * 86400L + hour({clock}) * 3600 + minute({clock}) * 60 "
        f"+ second({clock}) END"
    )


def _trunc(seconds: str) -> str:
    """Start of a unit's period: by arithmetic below a day, else by dates, which have no zone."""
    day = f"date_from_unix_date(CAST(({seconds} - pmod({seconds}, 86400L)) div 86400 AS INT))"
    return (
        f"CASE lower(u) WHEN 'second' THEN {seconds} WHEN 'minute' THEN {seconds} - pmod({seconds}, 60L) "
        f"WHEN 'hour' THEN {seconds} - pmod({seconds}, 3600L) WHEN 'day' THEN {seconds} - pmod({seconds}, 86400L) "
        f"ELSE unix_date(trunc({day}, u)) * 86400L END"
    )


_LOCAL = "unix_seconds(from_utc_timestamp(timestamp_seconds(t), z))"

TIME_FUNCTIONS = {
    "time_range": (
        "(t BIGINT, s STRING, e STRING) RETURNS BOOLEAN RETURN "
        f"(s IS NULL OR t >= {_bound('s')}) AND (e IS NULL OR t < {_bound('e')})"
    ),
    "epoch_trunc": f"(u STRING, t BIGINT) RETURNS BIGINT RETURN {_trunc('t')}",
    "epoch_trunc_in": (
        "(u STRING, t BIGINT, z STRING) RETURNS BIGINT RETURN "
        f"unix_seconds(to_utc_timestamp(timestamp_seconds({_trunc(_LOCAL)}), z))"
    ),
    "epoch_format": (
        "(t BIGINT, p STRING) RETURNS STRING RETURN "
        "date_format(to_utc_timestamp(timestamp_seconds(t), current_timezone()), p)"
    ),
    "epoch_format_in": (
        "(t BIGINT, p STRING, z STRING) RETURNS STRING RETURN "
        "date_format(to_utc_timestamp(from_utc_timestamp(timestamp_seconds(t), z), current_timezone()), p)"
    ),
}


def register_time_functions(spark: SparkSession, database: str | None = None) -> None:
    """Create the functions for this session, or in ``database`` for every session.

    A function in a database keeps the time zone of the session that created it.
    """
    for name, body in TIME_FUNCTIONS.items():
        if database is None:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        else:
            spark.sql(f"CREATE OR REPLACE FUNCTION `{database}`.{name}{body}")
