"""Inventory of databases and tables with counts and last log times."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.operators.timecols import TIME
from tidetable.session import isolated_session
from tidetable.sinks.snapshots import DATA_MARK, current, store_of
from tidetable.sinks.tables import Destination

# Counts and extremes of Parquet files from their footers.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _details(spark: SparkSession, identifier: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier}").collect()
    at = next((i for i, r in enumerate(rows) if r.col_name.startswith("# Detailed Table")), len(rows))
    return {r.col_name: r.data_type for r in rows[at + 1 :]}


def _stored_bytes(table: DataFrame, details: dict[str, str]) -> int | None:
    """Size of the table's files: from statistics if there are any, else the planner's figure for them."""
    found = re.match(r"(\d+) bytes", details.get("Statistics", ""))
    if found:
        return int(found.group(1))
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    unknown = table.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1))
    return None if str(size) == unknown else int(str(size))


def _of_footers(footers: SparkSession, table: DataFrame, details: dict[str, str]) -> DataFrame | None:
    """The table as a scan whose counts and extremes come from the footers of its files, if they can.

    Spark pushes such aggregates into Parquet scans of its newer kind; ``footers`` is a session that
    has them. Partitioned tables may have partitions anywhere, so their files are not listed here.
    """
    if details.get("Provider") != "parquet" or "Location" not in details:
        return None
    return footers.read.schema(table.schema).parquet(details["Location"])


def _by_file(table: DataFrame, last: Column) -> DataFrame:
    """Count, last time and size of a table whose size is not known, from its files as they are read."""
    files = table.groupBy(F.col("_metadata.file_path")).agg(
        F.count(F.lit(1)).alias("rows"), last.alias("last"), F.max("_metadata.file_size").alias("size")
    )
    return files.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("count"),
        F.max("last").alias("last"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    )


def _created(text: Column) -> Column:
    # e.g. "Tue Dec 01 08:28:18 UTC 2026"
    form = r"^\w+ (\w+ \d+ [\d:]+) (\S+) (\d+)$"
    parts = F.concat_ws(" ", *[F.regexp_extract(text, form, i) for i in (1, 3, 2)])
    return F.when(text.rlike(form), F.to_timestamp(parts, "MMM dd HH:mm:ss yyyy z"))


def _is_table(spark: SparkSession, db: str, name: str, kind: str) -> bool:
    """Whether a catalog entry is a table to its users: files of versions are not, their views are."""
    if DATA_MARK in name:
        return False
    return kind != "VIEW" or store_of(Destination(spark, db, name)) is not None


def _table_names(spark: SparkSession, pattern: str, database: str | None) -> list[tuple[str, str]]:
    databases = [database] if database else [d.name for d in spark.catalog.listDatabases()]
    found = []
    for db in databases:
        for table in spark.catalog.listTables(db):
            wanted = not table.isTemporary and re.search(pattern, f"{db}.{table.name}")
            if wanted and _is_table(spark, db, table.name, table.tableType):
                found.append((db, table.name))
    return sorted(found)


def list_tables(
    spark: SparkSession, pattern: str = "", database: str | None = None, exact: bool = True
) -> DataFrame:
    """One row per table whose ``db.table`` contains a match of ``pattern``.

    With ``exact=False`` no table is read: counts and last log times are NULL.
    Tables with versions are not read either: their loads were counted when they came. Of plain
    Parquet tables the files' footers are read, all tables in one job; of others one aggregate
    each, computed when the frame runs.
    """
    known: list[tuple] = []
    parts: list[DataFrame] = []
    measured: list[DataFrame] = []
    footers: SparkSession | None = None
    for db, name in _table_names(spark, pattern, database):
        dest = Destination(spark, db, name)
        details = _details(spark, dest.sql)
        created = details.get("Created Time")
        now = current(dest)
        if now is not None:
            last = max((x.last for x in now.loads if x.last is not None), default=None)
            count = sum(x.rows for x in now.loads)
            stored = sum(x.bytes for x in now.loads)
            known.append((db, name, count if exact else None, stored, last if exact else None, created))
            continue
        table = spark.table(dest.sql)
        size = _stored_bytes(table, details)
        if not exact:
            known.append((db, name, None, size, None, created))
            continue
        has_time = TIME in table.columns and table.schema[TIME].dataType.typeName() in ("long", "integer")
        last = F.max(F.col(TIME)) if has_time else F.lit(None).cast("bigint")
        plain = None
        if size is not None and not dest.partition_columns:
            footers = footers or isolated_session(spark, _FOOTERS)
            plain = _of_footers(footers, table, details)
        labels = [F.lit(db).alias("db_name"), F.lit(name).alias("name")]
        if plain is not None:
            counted = plain.agg(F.count(F.lit(1)).alias("count"), last.cast("bigint").alias("last"))
            bytes_ = F.lit(size).cast("bigint").alias("bytes")
            measured.append(counted.select(*labels, "count", bytes_, "last", F.lit(created).alias("created")))
            continue
        if size is None:
            counted = _by_file(table, last)
        else:
            counted = table.agg(F.count(F.lit(1)).alias("count"), last.alias("last"), F.lit(size).alias("bytes"))
        parts.append(counted.select(*labels, "count", F.col("bytes").cast("bigint"), F.col("last").cast("bigint"), F.lit(created).alias("created")))
    if measured:
        # Without a file there is no footer, hence no count.
        known += [(r.db_name, r.name, r[2] or 0, *r[3:]) for r in reduce(DataFrame.unionByName, measured).collect()]
    listed = spark.createDataFrame(known, "db_name string, name string, count bigint, bytes bigint, last bigint, created string")
    rows = reduce(DataFrame.unionByName, parts, listed)
    return rows.select(
        "db_name",
        "name",
        "count",
        F.col("bytes").alias("estimated_storage_size"),
        F.timestamp_seconds("last").alias("last_log_timestamp"),
        _created(F.col("created")).alias("created_at"),
    )


def list_databases(spark: SparkSession, pattern: str = "") -> DataFrame:
    """One row per database whose name contains a match of ``pattern``.

    ``count`` is the number of records in its tables; ``created_at`` and ``updated_at``
    come from its oldest table and its newest record, as the catalog keeps no times for
    databases.
    """
    names = [d.name for d in spark.catalog.listDatabases() if re.search(pattern, d.name)]
    schema = "name string"
    listed = spark.createDataFrame([(n,) for n in sorted(names)], schema)
    tables = [list_tables(spark, database=n) for n in sorted(names)]
    if not tables:
        return listed.selectExpr(
            "name", "0L AS count", "CAST(NULL AS TIMESTAMP) AS created_at", "CAST(NULL AS TIMESTAMP) AS updated_at"
        )
    totals = (
        reduce(DataFrame.unionByName, tables)
        .groupBy(F.col("db_name").alias("name"))
        .agg(
            F.sum("count").alias("count"),
            F.min("created_at").alias("created_at"),
            F.max("last_log_timestamp").alias("updated_at"),
        )
    )
    return listed.join(totals, "name", "left").select(
        "name", F.coalesce("count", F.lit(0)).alias("count"), "created_at", "updated_at"
    )
