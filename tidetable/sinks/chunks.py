"""Files of a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.operators.shape import evaluated_once

# Default rows per file, and the most files a load is cut into.
CHUNK_ROWS = 10_000
MAX_CHUNKS = 200


def rows_per_file(n_rows: int, chunk_rows: int = CHUNK_ROWS) -> int:
    """Rows per file so that a load has about 200 files at most."""
    return max(chunk_rows, -(-n_rows // MAX_CHUNKS))


def chunked(frame: DataFrame, chunk_rows: int) -> tuple[DataFrame, dict[str, str], DataFrame]:
    """The frame dealt over the files that its count allows, the setting that caps them, and the
    frame that was counted.

    A frame that only reads files is counted where it lies; any other is written once to be counted.
    Rows go by their place in the frame into chunks of ``cap`` rows, each chunk whole into one task,
    so that no file but the last is short and none is split by the cap.
    """
    counted = evaluated_once(frame, "chunks")
    part = F.spark_partition_id()
    # One count per part of the input: where each part's rows begin.
    sizes = counted.groupBy(part.alias("part")).count().collect()
    n_rows = sum(r["count"] for r in sizes)
    cap = rows_per_file(n_rows, chunk_rows)
    starts, begin = [0] * (max((r["part"] for r in sizes), default=-1) + 1), 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        starts[r["part"]], begin = begin, begin + r["count"]
    # The id's lower 33 bits number the rows within their part.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts] or [F.lit(0)]), part + 1)
    chunk = F.floor((start + place) / F.lit(cap))
    n_chunks = max(1, -(-n_rows // cap))
    dealt = counted.withColumn("__chunk", chunk).repartition(n_chunks, "__chunk").drop("__chunk")
    return dealt, {"spark.sql.files.maxRecordsPerFile": str(cap)}, counted
