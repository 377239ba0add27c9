"""Queries that group, count, resample and pivot (A*)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.functions.timefuncs import as_epoch
from tidetable.operators import aggregate, bucket_aggregate, pivot_result, resample, shape_result, value_counts
from tidetable.operators.rowindex import add_row_index
from tidetable.plans.registry import EVENTS_SQL, events_with_time, loaded_events, query, table
from tidetable.sources import run_query


@query(
    "group_counts",
    "A1 O1",
    """SELECT l_returnflag, l_linestatus, count(*) AS n,
    row_number() OVER (ORDER BY l_returnflag, l_linestatus DESC) - 1 AS place FROM lineitem GROUP BY 1, 2""",
)
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"""SELECT l_returnflag, l_linestatus, count(1) AS n FROM parquet.`{sf_dir}/lineitem.parquet`
               GROUP BY 1, 2 ORDER BY 1, 2 DESC"""
    return add_row_index(run_query(spark, text), name="place")


@query(
    "group_statistics",
    "A2",
    """SELECT l_returnflag, l_linestatus, min(l_discount) AS low, max(l_extendedprice) AS high,
    sum(l_quantity) AS quantity, round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def group_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = aggregate(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "low": ("min", "l_discount"),
            "high": ("max", "l_extendedprice"),
            "quantity": ("sum", "l_quantity"),
            "mean": ("avg", "l_quantity"),
            "n": ("count", "*"),
        },
    )
    return grouped.withColumn("mean", F.round("mean", 6))


@query("table_count", "A3", "SELECT count(*) AS n, count(value) AS n_value FROM events")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_query(spark, f"SELECT count(1) AS n, count(value) AS n_value FROM {loaded_events(spark, sf_dir)}")


@query(
    "daily_summary",
    "A4 F3 C3",
    EVENTS_SQL
    + """SELECT time - time % 86400 AS time, count(*) AS n, min(value) AS low, max(value) AS high,
    round(sum(value), 4) AS total FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-02') AND time < epoch(TIMESTAMP '2024-01-29') GROUP BY 1""",
)
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = bucket_aggregate(
        events_with_time(spark, sf_dir),
        "day",
        {"n": ("count", "*"), "low": ("min", "value"), "high": ("max", "value"), "total": ("sum", "value")},
        time_range=("2024-01-02", "2024-01-29"),
    )
    return grouped.withColumn("total", F.round("total", 4))


@query(
    "monthly_by_key",
    "A4",
    """SELECT CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) AS time, o_orderstatus, count(*) AS n,
    max(o_totalprice) AS high FROM orders GROUP BY 1, 2""",
)
def monthly_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("time", as_epoch(F.col("o_orderdate"), T.TimestampNTZType()))
    return bucket_aggregate(orders, "month", {"n": ("count", "*"), "high": ("max", "o_totalprice")}, by=["o_orderstatus"])


@query(
    "value_counts",
    "A5",
    """SELECT kind, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, kind) - 1 AS place
    FROM (SELECT nullif(event_type, 'view') AS kind FROM events) WHERE kind IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place in the result is a column, so that the order is compared too."""
    kinds = table(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("view")).alias("kind"))
    return add_row_index(value_counts(kinds, "kind", "n"), name="place")


@query(
    "resample_monthly",
    "A6",
    """WITH m AS (SELECT date_trunc('month', o_orderdate) AS p, max(o_totalprice) AS high, count(*) AS n
      FROM orders GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(p)::TIMESTAMP FROM m), (SELECT max(p)::TIMESTAMP FROM m),
      INTERVAL 1 MONTH)) AS p)
    SELECT CAST(epoch(spine.p) AS BIGINT) AS time, high, coalesce(n, 0) AS n FROM spine LEFT JOIN m ON m.p = spine.p""",
)
def resample_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    filled = resample(orders, "month", {"high": ("max", "o_totalprice"), "n": ("count", "*")}, time="o_orderdate")
    return filled.withColumnRenamed("o_orderdate", "time")


@query(
    "resample_orders_hourly",
    "A6",
    """WITH h AS (SELECT date_trunc('hour', o_orderdate) AS p, max(o_totalprice) AS high, count(*) AS n
      FROM orders GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(p)::TIMESTAMP FROM h), (SELECT max(p)::TIMESTAMP FROM h),
      INTERVAL 1 HOUR)) AS p)
    SELECT CAST(epoch(spine.p) AS BIGINT) AS time, high, coalesce(n, 0) AS n FROM spine LEFT JOIN h ON h.p = spine.p""",
)
def resample_orders_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates are midnights, so 23 of 24 hours are gaps to fill."""
    orders = table(spark, sf_dir, "orders")
    filled = resample(orders, "hour", {"high": ("max", "o_totalprice"), "n": ("count", "*")}, time="o_orderdate")
    return filled.withColumnRenamed("o_orderdate", "time")


@query(
    "resample_hourly",
    "A6",
    EVENTS_SQL
    + """, h AS (SELECT time - time % 3600 AS time, max(value) AS high, count(*) AS n FROM ev GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(time) FROM h), (SELECT max(time) FROM h), 3600)) AS time)
    SELECT CAST(spine.time AS BIGINT) AS time, high, coalesce(n, 0) AS n
    FROM spine LEFT JOIN h ON h.time = spine.time""",
)
def resample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_with_time(spark, sf_dir)
    return resample(events, "hour", {"high": ("max", "value"), "n": ("count", "*")})


@query(
    "resample_month_end",
    "A6",
    """WITH m AS (SELECT date_trunc('month', o_orderdate) AS p, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total
      FROM orders GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(p)::TIMESTAMP FROM m), (SELECT max(p)::TIMESTAMP FROM m),
      INTERVAL 1 MONTH)) AS p)
    SELECT CAST(epoch(spine.p + INTERVAL 1 MONTH - INTERVAL 1 DAY) AS BIGINT) AS time,
    CAST(coalesce(total, 0) AS DOUBLE) AS total FROM spine LEFT JOIN m ON m.p = spine.p""",
)
def resample_month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    exact = orders.select("o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    filled = resample(exact, "month", {"total": ("sum", "price")}, time="o_orderdate", label="end")
    return filled.withColumn("total", F.col("total").cast("double")).withColumnRenamed("o_orderdate", "time")


_KINDS = ("click", "error", "purchase", "signup", "view")
_DAILY_PIVOT_SQL = (
    EVENTS_SQL
    + "SELECT time - time % 86400 AS time, "
    + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{k}'), 6) AS {k}" for k in _KINDS)
    + " FROM ev GROUP BY 1"
)


def daily_average_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average value per day and event type."""
    daily = bucket_aggregate(events_with_time(spark, sf_dir), "day", {"mean": ("avg", "value")}, by=["event_type"])
    return daily.withColumn("mean", F.round("mean", 6))


@query("pivot_daily_average", "A7 A4", _DAILY_PIVOT_SQL)
def pivot_daily_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_result(daily_average_by_type(spark, sf_dir))


@query("pivot_given_values", "A7", _DAILY_PIVOT_SQL)
def pivot_given_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_result(daily_average_by_type(spark, sf_dir), values=_KINDS)


@query(
    "pivot_more_dimensions",
    "A7",
    "SELECT l_linenumber, "
    + ", ".join(
        f"count(*) FILTER (WHERE {w}) AS {n}_n, max(l_extendedprice) FILTER (WHERE {w}) AS {n}_high"
        for n, w in (
            (f"{f}_{s}", f"l_returnflag = '{f}' AND l_linestatus = '{s}'") for f in "ANR" for s in "FO"
        )
    )
    + " FROM lineitem GROUP BY 1",
)
def pivot_more_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = aggregate(
        table(spark, sf_dir, "lineitem"),
        ["l_linenumber", "l_returnflag", "l_linestatus"],
        {"n": ("count", "*"), "high": ("max", "l_extendedprice")},
    )
    wide = pivot_result(grouped, values=[(f, s) for f in "ANR" for s in "FO"])
    # A cell without rows has no count; the SQL counts it as 0.
    return wide.fillna(0, subset=[c for c in wide.columns if c.endswith("_n")])


@query(
    "shape_result_pivot",
    "A7 C8 C10",
    EVENTS_SQL
    + "SELECT strftime(make_timestamp((time - time % 86400) * 1000000), '%Y-%m-%d') AS time, "
    + ", ".join(f"max(value) FILTER (WHERE event_type = '{k}') AS {k}" for k in _KINDS)
    + " FROM ev GROUP BY 1",
)
def shape_result_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = bucket_aggregate(events_with_time(spark, sf_dir), "day", {"high": ("max", "value")}, by=["event_type"])
    wide = shape_result(daily.withColumn("empty", F.lit(None).cast("double")), dropna=True, pivot=True)
    return wide.withColumn("time", F.date_format("time", "yyyy-MM-dd"))


@query(
    "pivot_of_a_python_function",
    "A7",
    """SELECT o_orderkey AS key, max(CASE WHEN o_custkey % 3 = 0 THEN o_totalprice END) AS k0,
    max(CASE WHEN o_custkey % 3 = 1 THEN o_totalprice END) AS k1,
    max(CASE WHEN o_custkey % 3 = 2 THEN o_totalprice END) AS k2 FROM orders GROUP BY o_orderkey""",
)
def pivot_of_a_python_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the columns and their values come from one evaluation of the user's function."""

    def kinds(batches):
        for batch in batches:
            names = pa.array([f"k{c.as_py() % 3}" for c in batch.column("o_custkey")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("o_orderkey"), names, batch.column("o_totalprice")], names=["key", "kind", "price"]
            )

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return pivot_result(orders.mapInArrow(kinds, "key long, kind string, price double"))
