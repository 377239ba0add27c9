"""Row-by-row iteration over a result of any size."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame


def iter_rows(df: DataFrame, prefetch: bool = True) -> Iterator[tuple[int, dict[str, object]]]:
    """Yield ``(position, row as dict)``; the driver holds one partition (two if prefetching)."""
    for i, row in enumerate(df.toLocalIterator(prefetchPartitions=prefetch)):
        yield i, row.asDict()
