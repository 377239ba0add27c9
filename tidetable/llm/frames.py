"""Small helpers that the corpus operators share."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.session import scratch_path, written


def work_path(spark: SparkSession, tag: str) -> str:
    """A new folder in the application's part of the shared folder, deleted when the application ends."""
    return scratch_path(spark, f"corpus-{tag}")


def find_code(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver does, if they can see that folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder now and read it back, which cuts its lineage.

    ``discard`` deletes its files once nothing reads them any more.
    """
    return written(df, f"corpus-{tag}")


#: Bytes of a table's files that a sorting task should get.
TASK_BYTES = 128 << 20


def sort_tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions, or more where the size of the input's files asks for it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size < 2**62
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES if known else 0)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and folder of a URI, for tasks that read and write files of their own format."""
    store, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    store.create_dir(path, recursive=True)
    return store, path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_struct(df: DataFrame) -> Column:
    """All columns of ``df`` in one, where no name meets those an operator uses."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def whole_text(text: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def prefix_sums(values: Column, block: int = 256) -> Column:
    """Exclusive running sums of an integer array: as long as the array, beginning with 0.

    Appending to an array copies it, so the sums are made within blocks and the blocks'
    totals are summed apart; very long arrays then stay far from quadratic work.
    """
    n = F.size(values)
    zero = F.array().cast("array<int>")

    def running(items: Column) -> Column:
        start = F.struct(zero.alias("done"), F.lit(0).alias("at"))
        return F.aggregate(
            items,
            start,
            lambda acc, x: F.struct(
                F.concat(acc["done"], F.array(acc["at"])).alias("done"), (acc["at"] + x).alias("at")
            ),
            lambda acc: acc["done"],
        )

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), lambda acc, x: acc + x)

    starts = F.sequence(F.lit(1), n, F.lit(block))
    blocks = F.transform(starts, lambda i: F.slice(values, i, block))
    bases = running(F.transform(blocks, total))
    spread = F.flatten(
        F.zip_with(blocks, bases, lambda b, base: F.transform(running(b), lambda x: x + base))
    )
    return F.when(n <= 0, zero).when(n <= block, running(values)).otherwise(spread)


def text_runs(
    batches: Iterator[pa.RecordBatch], size: int = 2 << 20, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a string or binary column of each holds about ``size`` bytes.

    A single longer text is a batch of its own.
    """
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, length in enumerate(lengths):
            if i > begin and held + length > size:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += length
        if begin < len(lengths):
            yield batch.slice(begin)
