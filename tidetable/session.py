"""Session settings the toolkit relies on, and the shared scratch folder."""

from __future__ import annotations

import json
import threading
import time as clock
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Unix-second arithmetic needs UTC; a join followed by a grouping on the same key
# is only split by AQE when the extra shuffle is allowed explicitly.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_spark(app_name: str = "tidetable", **settings: str) -> SparkSession:
    """Build (or reuse) a session with the settings above; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate(), **settings)


def configure(spark: SparkSession, **settings: str) -> SparkSession:
    """Apply the runtime settings and register the SQL time functions in ``spark``."""
    from tidetable.functions.sqlfuncs import register_time_functions

    for key, value in {**SESSION_SETTINGS, **settings}.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    register_time_functions(spark)
    return spark


def isolated_session(spark: SparkSession, settings: Mapping[str, str] | None = None) -> SparkSession:
    """A second session on the same catalog, carrying over the caller's runtime settings.

    A DataFrame keeps the session it was built in, so a setting made here holds for that
    query whenever it runs and never reaches the caller's other queries.
    """
    current = spark.conf.getAll
    other = spark.newSession()
    for key, value in current.items():
        if key.startswith("spark.sql.") and other.conf.isModifiable(key):
            other.conf.set(key, value)
    return configure(other, **dict(settings or {}))


@contextmanager
def sql_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set SQL settings for the actions inside the block, then restore them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it, or
    the warehouse where that is not set.

    Where neither was set, the warehouse is a folder of the driver's machine, which serves a local
    session only; elsewhere this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir")
        unset = root.startswith("file:") and root.rstrip("/").endswith("/spark-warehouse")
        if unset and not spark.sparkContext.master.startswith(("local[", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/tidetable"


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the application's part of the shared folder, never used before.

    What lies there is deleted when the application ends.
    """
    return f"{own_folder(spark)}/{tag}-{uuid.uuid4().hex}"


#: The record that tells whose an application's folder is, and when it last gave a sign of life.
OWNER = "owner.json"
#: Seconds between signs of life, and after which a folder without any is taken for abandoned.
SIGN_EVERY, ABANDONED_AFTER = 600.0, 86_400.0
_claimed: set[str] = set()


def own_folder(spark: SparkSession) -> str:
    """The application's folder in the shared one, claimed at its first use."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _claimed:
        _claim(spark, folder)
        _claimed.add(folder)
    return folder


def _claim(spark: SparkSession, folder: str) -> None:
    """Leave the owner's record, have the folder deleted at the driver's end, clear up after others."""
    from tidetable.sinks.storage import delete_at_exit, write_text

    def sign() -> None:
        write_text(spark, f"{folder}/{OWNER}", json.dumps({"application": folder.rsplit("/", 1)[1], "at": clock.time()}))

    def keep_signing() -> None:
        while True:
            clock.sleep(SIGN_EVERY)
            try:
                sign()
            except Exception:  # the session has ended
                return

    sign()
    delete_at_exit(spark, folder)
    threading.Thread(target=keep_signing, daemon=True).start()
    sweep_abandoned(spark)


def sweep_abandoned(spark: SparkSession, after: float = ABANDONED_AFTER) -> list[str]:
    """Delete the folders of applications that ended without doing so; returns their names."""
    from tidetable.sinks.storage import child_names, delete_path, read_text

    root, swept = shared_dir(spark), []
    for name in child_names(spark, root):
        if name == spark.sparkContext.applicationId:
            continue
        record = read_text(spark, f"{root}/{name}/{OWNER}")
        if record is not None and clock.time() - json.loads(record)["at"] > after:
            delete_path(spark, f"{root}/{name}")
            swept.append(name)
    return swept


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder now and return a frame that reads it back.

    Cuts the lineage in a way that survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a frame from :func:`written` that nothing reads any more; others are left alone."""
    from tidetable.sinks.storage import delete_path

    path = getattr(df, "_written_at", None)
    if path is not None:
        delete_path(df.sparkSession, path)
