"""Keeping the rows of a query under an id and reading them again."""

from __future__ import annotations

import json
import re
import threading
import time as clock
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidetable.errors import ResultFailedError, ResultNotReadyError
from tidetable.operators.shape import key_first
from tidetable.operators.timecols import parse_dates
from tidetable.session import shared_dir
from tidetable.sinks.storage import create_once, delete_path, path_exists, read_text, write_text

#: Seconds between a writer's signs of life, and after which one without any is taken for dead.
BEAT, DEAD_AFTER = 5.0, 60.0


def _result_path(spark: SparkSession, result_id: str | int, root: str | None) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", str(result_id)):
        raise ValueError(f"result id may hold letters, digits, - and _ only: {result_id!r}")
    return f"{(root or shared_dir(spark)).rstrip('/')}/results/{result_id}"


def _status_path(path: str) -> str:
    return f"{path}.status"


def _record(state: str, cause: str | None = None) -> str:
    return json.dumps({"state": state, "at": clock.time(), "cause": cause})


def _status(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, _status_path(path))
    return None if text is None else json.loads(text)


def _is_dead(status: dict) -> bool:
    return status["state"] == "running" and clock.time() - status["at"] > DEAD_AFTER


class _Heartbeat:
    """Renews a running result's record until its writer is done."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._done = threading.Event()
        self._thread = threading.Thread(target=self._beat, daemon=True)

    def _beat(self) -> None:
        while not self._done.wait(BEAT):
            write_text(self._spark, _status_path(self._path), _record("running"))

    def __enter__(self) -> None:
        self._thread.start()

    def __exit__(self, *_: object) -> None:
        self._done.set()
        self._thread.join()


def save_result(df: DataFrame, result_id: str | int, root: str | None = None) -> str:
    """Write the rows of ``df`` under ``result_id``; an id in use raises. Returns the path.

    A record beside the rows says whether they are being written, done, or failed and why. The id
    of a result that failed, or whose writer died, may be used again.
    """
    spark = df.sparkSession
    path = _result_path(spark, result_id, root)
    before = _status(spark, path)
    if before is not None and (before["state"] == "failed" or _is_dead(before)):
        delete_path(spark, path)
        write_text(spark, _status_path(path), _record("running"))
    elif path_exists(spark, path) or not create_once(spark, _status_path(path), _record("running")):
        raise AnalysisException(f"result {result_id!r} exists already")
    try:
        with _Heartbeat(spark, path):
            df.write.mode("error").parquet(path)
    except BaseException as error:
        write_text(spark, _status_path(path), _record("failed", f"{type(error).__name__}: {error}"))
        raise
    write_text(spark, _status_path(path), _record("done"))
    return path


def read_result(
    spark: SparkSession,
    result_id: str | int,
    root: str | None = None,
    index_col: str | None = None,
    parse: Sequence[str] | Mapping[str, str] | None = None,
    wait_seconds: float = 0,
) -> DataFrame:
    """Rows saved under ``result_id``, with the schema they were saved with.

    A result still being written is waited for up to ``wait_seconds``. One that is missing, not
    finished by then, or whose writer gives no sign of life any more raises
    :class:`ResultNotReadyError`; one that failed raises :class:`ResultFailedError` with the cause
    at once. Row order is not kept.
    """
    path = _result_path(spark, result_id, root)
    deadline = clock.monotonic() + wait_seconds
    while not path_exists(spark, f"{path}/_SUCCESS"):
        status = _status(spark, path)
        if status is not None and status["state"] == "failed":
            raise ResultFailedError(f"result {result_id!r} failed: {status['cause']}")
        if status is not None and _is_dead(status):
            raise ResultNotReadyError(f"result {result_id!r} was left unfinished: its writer is gone")
        if clock.monotonic() >= deadline:
            raise ResultNotReadyError(f"result {result_id!r} is missing or not finished")
        clock.sleep(min(1.0, max(0.0, deadline - clock.monotonic())))
    return key_first(parse_dates(spark.read.parquet(path), parse), index_col)
