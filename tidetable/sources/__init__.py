"""Reading tables, queries, stored results and the catalog."""

from tidetable.sources.catalog import list_databases, list_tables
from tidetable.sources.queries import bind_placeholders, run_query
from tidetable.sources.results import read_result, save_result
from tidetable.sources.rows import iter_rows
from tidetable.sources.tables import read_table

__all__ = [
    "bind_placeholders",
    "iter_rows",
    "list_databases",
    "list_tables",
    "read_result",
    "read_table",
    "run_query",
    "save_result",
]
