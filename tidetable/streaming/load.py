"""Loading an unbounded source, batch by batch, without duplicates."""

from __future__ import annotations

import time as clock

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidetable.operators.timecols import TIME
from tidetable.sinks.load import load_table, prepare
from tidetable.sinks.sessions import FOLD_EVERY, check_fold_every, check_load_id, covering_load, fold_loads
from tidetable.sinks.snapshots import current, show
from tidetable.sinks.tables import Destination

#: Seconds after which SQL is shown the batches that have come since.
PUBLISH_SECONDS = 10.0


class LoadingQuery(StreamingQuery):
    """A running load; what it has stored when it is waited for or stopped is published for SQL too."""

    def __init__(self, running: StreamingQuery, publish) -> None:
        super().__init__(running._jsq)
        self._publish = publish

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        try:
            return super().awaitTermination(timeout)
        finally:
            self._publish()

    def processAllAvailable(self) -> None:
        try:
            super().processAllAvailable()
        finally:
            self._publish()

    def stop(self) -> None:
        super().stop()
        self._publish()


#: Options that say how rows are prepared, and with which one preparation can serve all batches.
_PREPARING = ("time_col", "add_time", "keep_arrays", "keep_bool")


def _prepared_once(stream: DataFrame, options: dict[str, object]) -> tuple[DataFrame, dict[str, object]]:
    """The stream with names, time and types as they will be stored, if they do not hang on the batch
    (the time it comes at, its text) or on the table's declared columns."""
    declared = options.get("schema") is not None or options.get("infer_text_types") or options.get("evolve")
    plain = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not all(isinstance(f.dataType, plain) for f in stream.schema):
        # What arrays and the like become follows the table.
        declared = True
    if declared or (options.get("time_col") is None and TIME not in stream.columns):
        return stream, options
    how = {k: v for k, v in options.items() if k in _PREPARING}
    rest = {k: v for k, v in options.items() if k not in _PREPARING}
    return prepare(stream, **how, lenient=True), rest | {"prepared": True}


def stream_load(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    query_name: str,
    trigger: dict[str, object] | None = None,
    fold_every: int = FOLD_EVERY,
    publish_seconds: float = PUBLISH_SECONDS,
    **options: object,
) -> StreamingQuery:
    """Start loading ``stream`` into table ``name``; returns the running query.

    Every micro-batch is a load named ``<query_name>-<batch>``: its files are staged and entered in
    the table's log, where ``read_table`` sees them at once; a batch that is run again after a failure
    replaces its own rows, so each row is stored once. SQL is shown many batches at a time, every
    ``publish_seconds`` and when the query is waited for or stopped. Finished batches are folded into
    fewer, larger loads every ``fold_every`` batches. ``checkpoint`` is a folder all executors share;
    restart with the same one and the same ``query_name``. The default trigger takes what is there
    and stops. Further options go to ``load_table``.
    """
    check_load_id(query_name)
    check_fold_every(fold_every)
    dest = Destination.of(stream.sparkSession, name)
    shown, first = clock.monotonic(), True

    def publish() -> None:
        nonlocal shown
        now = current(dest)
        if now is not None:
            show(dest, now)
        shown = clock.monotonic()

    def store(batch: DataFrame, batch_id: int) -> None:
        nonlocal first
        if first and covering_load(dest, query_name, batch_id):
            return  # folded already by the run before, so it was complete
        first = False
        load_table(
            batch, name, "append", load_id=f"{query_name}-{batch_id}", allow_empty=True, publish=False, **options
        )
        if (batch_id + 1) % fold_every == 0:
            fold_loads(dest, query_name, fold_every, view=False)
        if clock.monotonic() - shown >= publish_seconds:
            publish()

    stream, options = _prepared_once(stream, options)
    running = (
        stream.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(store)
        .start()
    )
    return LoadingQuery(running, publish)
