"""A gap-free row index for frames of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidetable.session import written

# monotonically_increasing_id() holds the partition number above these bits and the
# position inside the partition in them.
_POSITION_BITS = 33


# Bytes of input that a sorting task should get, and the most tasks asked for.
_TASK_BYTES, _MOST_TASKS = 256 * 1024 * 1024, 100_000


def _sort_tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions, or more where the input's known size asks for it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size < 2**62
    wanted = min(size // _TASK_BYTES, _MOST_TASKS) if known else 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def add_row_index(
    df: DataFrame,
    order_by: Sequence[str | Column] | str | Column | None = None,
    name: str = "index",
    partitions: int | None = None,
) -> DataFrame:
    """Append a 0-based index that follows ``order_by`` (or the present row order).

    One range shuffle sorts the rows; each task numbers its own rows and the partitions'
    starting points are summed from one count per partition. The numbered rows are written
    to the shared folder first: a recomputed shuffle could otherwise number them anew.
    Rows with equal keys are spread by a hash of the row, so no key fills one partition.
    ``partitions`` is the number of sorting tasks; by default it follows the input's size.
    """
    if name in df.columns:
        raise ValueError(f"the frame already has a column {name!r}")
    slot, tie, copy = "_slot", "_tie", "_copy"
    ordered = df
    if order_by is not None:
        keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
        keys = [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]
        hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        ordered = df.withColumns({tie: F.xxhash64(*hashed), copy: F.monotonically_increasing_id()})
        keys = [*keys, F.col(tie), F.col(copy)]
        ordered = ordered.repartitionByRange(partitions or _sort_tasks(df), *keys)
        ordered = ordered.sortWithinPartitions(*keys).drop(tie, copy)
    numbered = written(ordered.withColumn(slot, F.monotonically_increasing_id()), "rowindex")

    part = F.shiftright(F.col(slot), _POSITION_BITS)
    position = F.col(slot).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the written frame, so this window and the broadcast are
    # bounded by the number of tasks, not by the data.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + position).alias(name))
    )
