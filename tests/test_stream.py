from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidetable import read_table, stream_load
from tidetable.sinks import load as load_module
from tidetable.streaming import load as stream_module


@pytest.fixture
def source(spark, events, tmp_path):
    path = str(tmp_path / "in")
    events.drop("time").repartition(4).write.parquet(path)
    stream = spark.readStream.schema(events.drop("time").schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream, path


def ids(spark, name):
    row = read_table(spark, name, limit=None).agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("d")).first()
    return row.n, row.d


def test_every_row_once(spark, db, events, source, tmp_path):
    stream, path = source
    args = (f"{db}.live", str(tmp_path / "ckpt"), "feed")
    stream_load(stream, *args, time_col="ts").awaitTermination()
    n = events.count()
    assert ids(spark, f"{db}.live") == (n, n)
    assert spark.table(f"{db}.live").select("_load_id").distinct().count() == 4
    # Nothing new: nothing happens.
    stream_load(stream, *args, time_col="ts").awaitTermination()
    assert ids(spark, f"{db}.live") == (n, n)
    events.drop("time").limit(10).withColumn("event_id", F.col("event_id") + 10**6).write.mode("append").parquet(path)
    stream_load(stream, *args, time_col="ts").awaitTermination()
    spark.catalog.refreshTable(f"{db}.live")
    assert ids(spark, f"{db}.live") == (n + 10, n + 10)


def test_replayed_batch_is_not_doubled(spark, db, events, source, tmp_path, monkeypatch):
    stream, _ = source
    args = (f"{db}.live", str(tmp_path / "ckpt"), "feed")
    calls = []

    def fail_after_second(*a, **k):
        report = load_module.load_table(*a, **k)
        calls.append(report.load_id)
        if len(calls) == 2:
            raise RuntimeError("lost after the write")
        return report

    monkeypatch.setattr(stream_module, "load_table", fail_after_second)
    with pytest.raises(Exception, match="lost after the write"):
        stream_load(stream, *args, time_col="ts").awaitTermination()
    stream_load(stream, *args, time_col="ts").awaitTermination()
    assert calls == ["feed-0", "feed-1", "feed-1", "feed-2", "feed-3"]
    spark.catalog.refreshTable(f"{db}.live")
    n = events.count()
    assert ids(spark, f"{db}.live") == (n, n)


def test_bad_names_fail_early(spark, source, tmp_path):
    stream, _ = source
    with pytest.raises(ValueError):
        stream_load(stream, "nowhere.t", str(tmp_path / "c"), "feed")
    with pytest.raises(ValueError):
        stream_load(stream, "default.t", str(tmp_path / "c"), "a b")


def test_folds_take_two_loads_at_least(spark, source, db, tmp_path):
    stream, _ = source
    for every in (0, 1):
        with pytest.raises(ValueError, match="2 loads"):
            stream_load(stream, f"{db}.live", str(tmp_path / "c"), "feed", fold_every=every)


def test_sql_is_shown_many_batches_at_once(spark, db, events, source, tmp_path, monkeypatch):
    stream, _ = source
    shown = []
    real = stream_module.show
    monkeypatch.setattr(stream_module, "show", lambda dest, now: shown.append(len(now.loads)) or real(dest, now))
    query = stream_load(stream, f"{db}.live", str(tmp_path / "c"), "feed", publish_seconds=3600, time_col="ts")
    query.awaitTermination()
    n = events.count()
    assert shown == [4] and spark.table(f"{db}.live").count() == n and ids(spark, f"{db}.live") == (n, n)
