"""Loading, reading and shaping time-stamped event tables with Spark."""

from tidetable.errors import (
    LoadError,
    NoValidRecordsError,
    ResultFailedError,
    ResultNotReadyError,
    TableExistsError,
)
from tidetable.session import configure, get_spark
from tidetable.sinks import create_table, load_table, recast_columns, store_frame, write_csv
from tidetable.sources import (
    iter_rows,
    list_databases,
    list_tables,
    read_result,
    read_table,
    run_query,
    save_result,
)
from tidetable.streaming import stream_load

__all__ = [
    "LoadError",
    "NoValidRecordsError",
    "ResultFailedError",
    "ResultNotReadyError",
    "TableExistsError",
    "configure",
    "create_table",
    "get_spark",
    "iter_rows",
    "list_databases",
    "list_tables",
    "load_table",
    "read_result",
    "read_table",
    "recast_columns",
    "run_query",
    "save_result",
    "store_frame",
    "stream_load",
    "write_csv",
]
