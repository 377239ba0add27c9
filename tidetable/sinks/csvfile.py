"""Results as CSV files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidetable.operators.coerce import coerce


def write_csv(df: DataFrame, target: str, header: bool = True, mode: str = "error") -> str:
    """Write ``df`` as a folder of CSV files, each with a header; returns the path used.

    ``target`` is any path or URI Spark can write to; a leading ``~`` is expanded. The
    number of files follows the partitions, so no task carries the whole result.
    """
    nested = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.AtomicType) or f.dataType == T.BinaryType()]
    if nested:
        # CSV has cells of text only: arrays, maps, records and bytes are written as they would be stored.
        df = coerce(df, as_is=[c for c in df.columns if c not in nested])
    path = os.path.expanduser(target) if target.startswith("~") else target
    df.write.mode(mode).option("header", header).csv(path)
    return path
