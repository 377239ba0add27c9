"""Named queries over a folder of parquet tables, each with the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidetable.session import configure, scratch_path
from tidetable.sinks.load import load_table

Run = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The events table with the unix-second column a load gives it.
EVENTS_SQL = """WITH ev AS (
    SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS time,
           user_id, event_type, value, props
    FROM events
)
"""


@dataclass(frozen=True)
class Query:
    name: str
    items: tuple[str, ...]
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, items: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function as query ``name`` covering the given operator ids."""

    def register(run: Run) -> Run:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        configured.__doc__ = run.__doc__
        QUERIES[name] = Query(name, tuple(items.split()), configured, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database with a folder of its own in the shared folder."""
    name = f"tt_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


def loaded_events(spark: SparkSession, sf_dir: str) -> str:
    """Name of a table that holds the whole events with their time column."""
    name = f"{new_database(spark)}.events"
    load_table(table(spark, sf_dir, "events"), name, time_col="ts")
    return name


def events_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with unix seconds, straight from their file."""
    from tidetable.operators.timecols import build_time

    return build_time(table(spark, sf_dir, "events"), "ts")
