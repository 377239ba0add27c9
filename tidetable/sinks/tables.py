"""Catalog helpers shared by the sinks: destinations, creation, swap, removal."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOAD_ID, DAY = "_load_id", "_day"
#: Columns the toolkit keeps for itself.
HIDDEN = (LOAD_ID, DAY, "_run")
REJECTS = "__rejects"

# Accepted if_exists words and the policy each stands for.
POLICIES = {
    "error": "error",
    "fail": "error",
    "overwrite": "overwrite",
    "replace": "overwrite",
    "append": "append",
    "ignore": "ignore",
}


def policy(if_exists: str) -> str:
    """Policy for an ``if_exists`` word; anything else raises ``ValueError``."""
    if if_exists not in POLICIES:
        raise ValueError(f"invalid if_exists: {if_exists!r}; use one of {', '.join(POLICIES)}")
    return POLICIES[if_exists]


@dataclass(frozen=True)
class Destination:
    """A table in a database that exists."""

    spark: SparkSession
    database: str
    table: str

    @classmethod
    def of(cls, spark: SparkSession, name: str) -> Destination:
        """``"db.t"``, or ``"t"`` in the current database; a missing database raises."""
        parts = name.split(".")
        if len(parts) > 2 or not all(re.fullmatch(r"\w+", p) for p in parts):
            raise ValueError(f"not a table name: {name!r}")
        database = parts[0] if len(parts) == 2 else spark.catalog.currentDatabase()
        if not spark.catalog.databaseExists(database):
            raise ValueError(f"no such database: {database!r}")
        return cls(spark, database, parts[-1])

    def sibling(self, suffix: str) -> Destination:
        return Destination(self.spark, self.database, self.table + suffix)

    def beside(self, table: str) -> str:
        """A table of the same database, as it is written in SQL."""
        return f"`{self.database}`.`{table}`"

    @property
    def rejects(self) -> Destination:
        """Where the rows go that validated loads set aside."""
        return self.sibling(REJECTS)

    @property
    def loaded(self) -> Destination | None:
        """The table whose rejects this one holds, if it does."""
        name = self.table.removesuffix(REJECTS)
        return None if name == self.table else Destination(self.spark, self.database, name)

    @property
    def sql(self) -> str:
        return f"`{self.database}`.`{self.table}`"

    @property
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{self.table}")

    @property
    def schema(self) -> T.StructType:
        """Schema without the columns the toolkit keeps for itself."""
        return T.StructType([f for f in self.spark.table(self.sql).schema if f.name not in HIDDEN])

    @property
    def partition_columns(self) -> list[str]:
        columns = self.spark.catalog.listColumns(f"{self.database}.{self.table}")
        return [c.name for c in columns if c.isPartition]

    @property
    def folder(self) -> str:
        """Folder of the database."""
        rows = self.spark.sql(f"DESCRIBE DATABASE `{self.database}`").collect()
        return next(r.info_value for r in rows if r.info_name == "Location").rstrip("/")

    def refresh(self) -> None:
        self.spark.catalog.refreshTable(self.sql)


def _definition(field: T.StructField) -> str:
    text = f"`{field.name}` {field.dataType.simpleString()}"
    comment = field.metadata.get("comment")
    if comment:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        text += f" COMMENT '{quoted}'"
    return text


def column_list(schema: T.StructType, partitioned_by: Sequence[str] = ()) -> str:
    """The columns of a table as DDL, partition columns last."""
    columns = [_definition(f) for f in schema.fields]
    return ", ".join([*columns, *[f"`{c}` {'DATE' if c == DAY else 'STRING'}" for c in partitioned_by]])


def add_columns(dest: Destination, fields: Sequence[T.StructField], table: str | None = None) -> None:
    """Append columns to a table (or to one beside it); rows already stored read as NULL there."""
    if fields:
        columns = ", ".join(_definition(f) for f in fields)
        dest.spark.sql(f"ALTER TABLE {dest.sql if table is None else dest.beside(table)} ADD COLUMNS ({columns})")


def swap_in(dest: Destination, staged: Destination) -> None:
    """Put a finished staging table in the place of ``dest``, a table without versions.

    The old table is renamed away and dropped only once the new one has its name; if that
    fails it gets its name back. Readers can meet a moment without the table, never a lost one.
    """
    spark = dest.spark
    old = dest.sibling(f"__old_{uuid.uuid4().hex[:12]}")
    had = dest.exists
    if had:
        spark.sql(f"ALTER TABLE {dest.sql} RENAME TO {old.sql}")
    try:
        spark.sql(f"ALTER TABLE {staged.sql} RENAME TO {dest.sql}")
    except BaseException:
        if had:
            spark.sql(f"ALTER TABLE {old.sql} RENAME TO {dest.sql}")
        raise
    dest.refresh()
    spark.sql(f"DROP TABLE IF EXISTS {old.sql}")


def staging_for(dest: Destination) -> Destination:
    return dest.sibling(f"__stg_{uuid.uuid4().hex[:12]}")


def insert_by_name(dest: Destination, df: DataFrame) -> None:
    """Append by column name; columns the frame lacks are NULL, unknown ones raise (L3)."""
    dest.spark.sql(f"INSERT INTO {dest.sql} BY NAME SELECT * FROM {{rows}}", rows=df)
    dest.refresh()
