"""Writing frames to tables and files."""

from tidetable.sinks.csvfile import write_csv
from tidetable.sinks.load import LoadReport, from_pandas, load_table, rows_per_file, store_frame
from tidetable.sinks.recast import recast_columns
from tidetable.sinks.sessions import create_table, drop_table, fold_loads, loads_of
from tidetable.sinks.snapshots import vacuum
from tidetable.sinks.tables import Destination

__all__ = [
    "Destination",
    "LoadReport",
    "create_table",
    "drop_table",
    "fold_loads",
    "from_pandas",
    "load_table",
    "loads_of",
    "recast_columns",
    "rows_per_file",
    "store_frame",
    "vacuum",
    "write_csv",
]
