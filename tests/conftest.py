from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidetable.session import get_spark  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="session")
def events(spark):
    from pyspark.sql import functions as F

    raw = spark.read.parquet(f"{DATA}/events.parquet")
    return raw.withColumn("time", F.unix_seconds(F.col("ts").cast("timestamp")))
