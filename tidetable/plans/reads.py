"""Queries that read tables, run SQL and store results (R*, F*, C2, C3, C12, C13, J1, O*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.plans.registry import (
    EVENTS_SQL,
    TABLES,
    events_with_time,
    loaded_events,
    new_database,
    query,
    table,
)
from tidetable.functions import epoch_format, epoch_trunc, in_time_range
from tidetable.functions.timefuncs import as_epoch
from tidetable.session import scratch_path
from tidetable.sinks import load_table
from tidetable.sources import list_databases, list_tables, read_result, read_table, run_query, save_result


@query(
    "read_table_projected",
    "R1 C2 C3 C11 F2",
    EVENTS_SQL
    + """SELECT event_id, upper(event_type) AS kind, value * 2 AS twice FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-05') AND time < epoch(TIMESTAMP '2024-01-20 12:00:00')""",
)
def read_table_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(
        spark,
        loaded_events(spark, sf_dir),
        columns=["upper(event_type) AS kind", "value * 2 AS twice", "event_id"],
        time_range=("2024-01-05", dt.datetime(2024, 1, 20, 12)),
        limit=None,
        index_col="event_id",
    )


@query("read_table_whole", "R1", EVENTS_SQL + "SELECT * FROM ev")
def read_table_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, loaded_events(spark, sf_dir), limit=None)


@query("read_table_default", "R1", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def read_table_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many rows read without a word about a limit."""
    name = f"{new_database(spark)}.lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    load_table(lines, name, add_time=False)
    return read_table(spark, name)


@query(
    "read_limit_ordered",
    "R1 O1 O2",
    EVENTS_SQL + "SELECT event_id, value FROM ev ORDER BY value DESC, event_id LIMIT 100",
)
def read_limit_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k report."""
    return read_table(
        spark,
        loaded_events(spark, sf_dir),
        columns=["event_id", "value"],
        limit=100,
        order_by=[F.col("value").desc(), "event_id"],
    )


@query(
    "time_range_counts",
    "C3 F1",
    EVENTS_SQL
    + """SELECT count(*) AS n_all,
    count(*) FILTER (WHERE time >= 1704844800) AS n_from,
    count(*) FILTER (WHERE time < 1704844800) AS n_until,
    count(*) FILTER (WHERE time >= 1704844800 AND time < 1705708800) AS n_between FROM ev""",
)
def time_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("time")
    return events_with_time(spark, sf_dir).agg(
        F.count_if(in_time_range(time)).alias("n_all"),
        F.count_if(in_time_range(time, "2024-01-10")).alias("n_from"),
        F.count_if(in_time_range(time, None, 1704844800)).alias("n_until"),
        F.count_if(in_time_range(time, dt.date(2024, 1, 10), "2024-01-20 00:00:00+00:00")).alias("n_between"),
    )


@query(
    "sql_time_functions",
    "R2 F1 F3 F4 A4",
    EVENTS_SQL
    + """SELECT CAST(epoch(date_trunc('day', make_timestamp(time * 1000000))) AS BIGINT) AS day,
    strftime(make_timestamp(time * 1000000), '%Y-%m-01') AS month,
    count(*) AS n, min(value) AS low, max(value) AS high
    FROM ev WHERE time >= epoch(TIMESTAMP '2024-01-03') GROUP BY 1, 2""",
)
def sql_time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, name = loaded_events(spark, sf_dir).split(".")
    return run_query(
        spark,
        f"""SELECT epoch_trunc('day', time) AS day, epoch_format(time, 'yyyy-MM-01') AS month,
            count(*) AS n, min(value) AS low, max(value) AS high
            FROM {name} WHERE time_range(time, '2024-01-03', NULL) GROUP BY 1, 2""",
        db=database,
    )


@query(
    "epoch_trunc_units",
    "F3",
    """SELECT o_orderkey,
    CAST(epoch(date_trunc('year', o_orderdate)) AS BIGINT) AS y,
    CAST(epoch(date_trunc('quarter', o_orderdate)) AS BIGINT) AS q,
    CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) AS m,
    CAST(epoch(date_trunc('week', o_orderdate)) AS BIGINT) AS w,
    CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS d,
    CAST(epoch(date_trunc('day', o_orderdate + INTERVAL 9 HOUR)) AS BIGINT) - 32400 AS d_tokyo
    FROM orders""",
)
def epoch_trunc_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = as_epoch(F.col("o_orderdate"), T.TimestampNTZType())
    units = {"y": "year", "q": "quarter", "m": "month", "w": "week", "d": "day"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[epoch_trunc(unit, time).alias(name) for name, unit in units.items()],
        epoch_trunc("day", time, "Asia/Tokyo").alias("d_tokyo"),
    )


@query(
    "epoch_format_monthly",
    "F4",
    EVENTS_SQL
    + """SELECT strftime(make_timestamp(time * 1000000), '%Y-%m-01') AS month, count(*) AS n,
    sum(CAST(value AS DECIMAL(18, 2)))::DOUBLE AS total FROM ev GROUP BY 1""",
)
def epoch_format_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = epoch_format(F.col("time"), "yyyy-MM-01").alias("month")
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    return events_with_time(spark, sf_dir).groupBy(month).agg(F.count(F.lit(1)).alias("n"), total)


@query(
    "sql_bound_parameters",
    "R2 C12",
    EVENTS_SQL
    + """SELECT event_type, count(*) AS n FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-02') AND time < epoch(TIMESTAMP '2024-01-30')
    AND event_type IN ('click', 'view') AND event_type LIKE '%i%' GROUP BY 1""",
)
def sql_bound_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_query(
        spark,
        """SELECT event_type, count(*) AS n FROM IDENTIFIER({name})
           WHERE time_range(time, '{start}', '{end}') AND event_type IN ({a}, {b})
           AND event_type LIKE '%{part}%' GROUP BY 1""",
        {
            "name": loaded_events(spark, sf_dir), "start": "2024-01-02", "end": "2024-01-30",
            "a": "click", "b": "view", "part": "i",
        },
    )


@query(
    "sql_parameters_in_any_literal",
    "R2 C12",
    r"""SELECT event_id, 'it''s click' AS quoted, 'a\click' AS raw FROM events
    WHERE event_type LIKE '%lic%' AND user_id > 10""",
)
def sql_parameters_in_any_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders in literals of both quotes and raw ones, beside comments and names that hold quotes."""
    table(spark, sf_dir, "events").createOrReplaceTempView("events_by_any_quote")
    return run_query(
        spark,
        r"""SELECT event_id, "it's {kind}" AS quoted, /* a '{comment}' /* within */ isn't read */ r'a\{kind}' AS raw
           FROM events_by_any_quote -- nor is {this}, it's a comment
           WHERE event_type LIKE "%{part}%" AND `user_id` > :least""",
        {"kind": "click", "part": "lic", "least": 10},
    )


@query(
    "predicates",
    "C13",
    """SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_name LIKE 'red%' AND p_brand IN ('Brand#1', 'Brand#12', 'Brand#17') AND p_size >= 10""",
)
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    chosen = F.col("p_brand").isin("Brand#1", "Brand#12", "Brand#17")
    return part.where(F.col("p_name").like("red%") & chosen & (F.col("p_size") >= 10)).select(
        "p_partkey", "p_name", "p_brand"
    )


@query(
    "predicates_in_time_range",
    "C13 C3",
    EVENTS_SQL
    + """SELECT event_type, count(*) AS n, max(value) AS high FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-10') AND time < epoch(TIMESTAMP '2024-01-20')
    AND event_type LIKE '%i%' AND user_id = 7 GROUP BY 1""",
)
def predicates_in_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events_with_time(spark, sf_dir)
        .where(in_time_range(F.col("time"), "2024-01-10", "2024-01-20"))
        .where(F.col("event_type").like("%i%") & (F.col("user_id") == 7))
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("high"))
    )


_JOIN = """SELECT c_mktsegment, o_orderpriority, count(*) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderpriority"""
_JOIN_SQL = _JOIN.format(orders="orders", customer="customer")


def _join_in(sf_dir: str) -> str:
    return _JOIN.format(
        orders=f"parquet.`{sf_dir}/orders.parquet`", customer=f"parquet.`{sf_dir}/customer.parquet`"
    )


@query("join_broadcast", "J1 R2", _JOIN_SQL)
def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_query(spark, _join_in(sf_dir), join="broadcast")


@query("join_partitioned", "J1 R2", _JOIN_SQL)
def join_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_query(spark, _join_in(sf_dir), join="partitioned")


@query("join_default", "J1 R2", _JOIN_SQL)
def join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_query(spark, _join_in(sf_dir))


@query(
    "stored_result",
    "R3",
    """SELECT l_shipdate::DATE::VARCHAR AS day, strftime(l_shipdate, '%Y') AS year, count(*) AS n,
    sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem GROUP BY 1, 2""",
)
def stored_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )
    root = scratch_path(spark, "results")
    save_result(rows, "by-day", root)
    back = read_result(spark, "by-day", root, parse={"day": "%Y-%m-%d"})
    return back.withColumn("year", F.date_format("day", "yyyy")).withColumn("day", F.to_date("day").cast("string"))


_INVENTORY_SQL = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS count FROM {t}" for t in TABLES)


def _catalog_of(spark: SparkSession, sf_dir: str) -> str:
    """A database whose tables are the given files themselves."""
    database = new_database(spark)
    for name in TABLES:
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    return database


@query("catalog_tables", "R4", _INVENTORY_SQL)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_tables(spark, database=_catalog_of(spark, sf_dir)).select("name", "count")


@query("catalog_databases", "R4", f"SELECT sum(count)::BIGINT AS count FROM ({_INVENTORY_SQL})")
def catalog_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_databases(spark, f"^{_catalog_of(spark, sf_dir)}$").select("count")


@query(
    "catalog_last_log_time",
    "R4",
    EVENTS_SQL + "SELECT count(*) AS count, max(time) AS last_log FROM ev",
)
def catalog_last_log_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, name = loaded_events(spark, sf_dir).split(".")
    listed = list_tables(spark, f"^{database}\\.{name}$", database)
    return listed.select("count", F.unix_seconds("last_log_timestamp").alias("last_log"))
