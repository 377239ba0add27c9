"""Queries that load tables and read them back (L*, X1, C4-C6 on load)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.operators import declared_schema
from tidetable.plans.registry import EVENTS_SQL, events_with_time, new_database, query, table
from tidetable.session import isolated_session, scratch_path
from tidetable.sinks import create_table, load_table, recast_columns, rows_per_file, store_frame, write_csv
from tidetable.sources import read_table
from tidetable.streaming import stream_load


def _read(spark: SparkSession, name: str) -> DataFrame:
    return read_table(spark, name)


@query(
    "load_direct",
    "L1 L8 T1 T7",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, CAST(epoch(l_shipdate) AS BIGINT) AS time
    FROM lineitem""",
)
def load_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.lines"
    load_table(table(spark, sf_dir, "lineitem"), name, time_col="l_shipdate")
    return _read(spark, name)


@query("load_ignore", "L2", "SELECT s_suppkey, s_name FROM supplier")
def load_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    load_table(supplier, name, add_time=False)
    load_table(table(spark, sf_dir, "customer"), name, "ignore")
    return _read(spark, name)


@query(
    "load_overwrite_schema",
    "L2",
    "SELECT c_custkey, c_acctbal * 2 AS c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer",
)
def load_overwrite_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaces rows and schema, the second time from the table itself."""
    name = f"{new_database(spark)}.t"
    load_table(table(spark, sf_dir, "supplier"), name, add_time=False)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    load_table(customer, name, "overwrite", add_time=False)
    load_table(spark.table(name).withColumn("c_acctbal", F.col("c_acctbal") * 2), name, "replace", add_time=False)
    return _read(spark, name)


@query(
    "load_append_by_name",
    "L2 L3",
    """SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT c_custkey, NULL, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation""",
)
def load_append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order, columns left out, and a new column."""
    name = f"{new_database(spark)}.t"
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    load_table(supplier.selectExpr("s_suppkey AS key", "s_name AS name", "s_acctbal AS balance"), name, add_time=False)
    more = customer.selectExpr("c_mktsegment AS segment", "c_acctbal AS balance", "c_custkey AS key")
    load_table(more, name, "append", add_time=False, evolve=True)
    load_table(nation.selectExpr("n_name AS name", "n_nationkey AS key"), name, "append", add_time=False)
    return _read(spark, name)


def _with_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, some with a price that is no number or a date that is none."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 11 == 0, F.lit("soon")).otherwise(F.col("o_orderdate").cast("string")).alias("time"),
    )


def _orders_schema():
    return declared_schema(["o_orderkey", "o_totalprice", "time"], ["bigint", "double", "bigint"])


@query(
    "load_validated",
    "L4 L10",
    """SELECT o_orderkey, o_totalprice, CAST(epoch(o_orderdate) AS BIGINT) AS time FROM orders
    WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0""",
)
def load_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    load_table(_with_bad_rows(spark, sf_dir), name, validate=True, schema=_orders_schema())
    return _read(spark, name)


@query(
    "load_rejects",
    "L4",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 77 = 0 THEN 'o_totalprice is not double; time is null'
    WHEN o_orderkey % 7 = 0 THEN 'o_totalprice is not double' ELSE 'time is null' END AS reason,
    CASE WHEN o_orderkey % 11 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS time_text
    FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""",
)
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    load_table(_with_bad_rows(spark, sf_dir), name, validate=True, schema=_orders_schema())
    row = F.from_json("_row", "o_orderkey BIGINT, time STRING")
    return spark.table(f"{name}__rejects").select(
        row["o_orderkey"].alias("o_orderkey"), F.col("_reason").alias("reason"), row["time"].alias("time_text")
    )


def _part_of(key: str):
    """One of three parts by a hash of the key, a missing key included."""
    return F.pmod(F.hash(key), F.lit(3))


@query(
    "load_replay",
    "L5",
    EVENTS_SQL + "SELECT event_id, event_type, time FROM ev",
)
def load_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads that hold all events between them; two of them are run twice."""
    name = f"{new_database(spark)}.t"
    events = events_with_time(spark, sf_dir).select("event_id", "event_type", "time")
    for part in (0, 1, 2, 1, 2):
        load_table(events.where(_part_of("event_id") == part), name, "append", load_id=f"part-{part}")
    return _read(spark, name)


@query("load_chunked", "L6", "SELECT true AS within, true AS few_files, count(*) AS n FROM lineitem")
def load_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    lines = table(spark, sf_dir, "lineitem")
    cap = rows_per_file(lines.count(), 5000)
    load_table(lines, name, chunk_rows=5000, validate=True)
    files = spark.table(name).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("rows"))
    few = F.count(F.lit(1)) <= F.ceil(F.sum("rows") / cap) + F.lit(1)
    return files.agg((F.max("rows") <= cap).alias("within"), few.alias("few_files"), F.sum("rows").alias("n"))


@query(
    "load_guessed_types",
    "L7",
    """SELECT o_orderkey AS code, o_totalprice AS price, o_orderstatus AS status,
    CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END AS dear, nullif(o_orderpriority, '5-LOW') AS level
    FROM orders""",
)
def load_guessed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    low = F.col("o_orderpriority") == "5-LOW"
    text = table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("code"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") > 250000, F.lit("True")).otherwise(F.lit("FALSE")).alias("dear"),
        F.when(low, F.lit("NA")).otherwise(F.col("o_orderpriority")).alias("level"),
    )
    load_table(text, name, add_time=False, infer_text_types=True)
    return _read(spark, name)


@query("write_csv", "L9", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").drop("c_nationkey")
    path = write_csv(rows, scratch_path(spark, "csv"))
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query(
    "load_declared",
    "L10",
    """SELECT CAST(p_size AS VARCHAR) AS size, CAST(p_partkey AS DOUBLE) AS part, NULL::VARCHAR AS note,
    CAST(p_size AS BIGINT) AS time FROM part""",
)
def load_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    schema = declared_schema(["size", "part", "note", "time"], ["varchar(8)", "double", "varchar", "bigint"])
    part = table(spark, sf_dir, "part").selectExpr("p_partkey AS part", "p_size AS time", "p_size AS size")
    load_table(part, name, schema=schema)
    return _read(spark, name)


@query(
    "load_open_table",
    "L10 L3",
    "SELECT CAST(epoch(o_orderdate) AS BIGINT) AS time, o_orderkey FROM orders",
)
def load_open_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    create_table(spark, name)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    load_table(orders, name, "append", time_col="o_orderdate", evolve=True)
    return _read(spark, name)


@query(
    "recast_columns",
    "L11",
    """SELECT o_orderkey, o_custkey + o_orderkey AS total, CAST(o_custkey AS DOUBLE) AS customer FROM orders""",
)
def recast(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"), F.lit(None)).alias("keys"),
        F.col("o_custkey").alias("customer"),
    )
    load_table(orders, name, add_time=False, keep_arrays=True)
    recast_columns(spark, name, [("keys", "array<bigint>", "both keys"), ("customer", "double")])
    return _read(spark, name).selectExpr("o_orderkey", "keys[0] + keys[1] AS total", "customer")


@query(
    "recast_session_table",
    "L11 L5",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, 1 AS time FROM orders",
)
def recast_session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.lit(1).alias("time"))
    for part in range(3):
        load_table(orders.where(_part_of("o_orderkey") == part), name, "append", load_id=f"part-{part}")
    recast_columns(spark, name, [("o_custkey", "varchar")])
    return _read(spark, name)


@query(
    "store_frame",
    "C4 C5 C6 L1",
    """SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS time, strftime(o_orderdate + INTERVAL 1 DAY, '%d.%m.%Y') AS due,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders""",
)
def stored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderdate AS at", "o_orderdate + INTERVAL 1 DAY AS due"
    )
    store_frame(
        orders, name, time_col="at", index=True, index_label="position",
        order_by=["time", "o_orderkey"], date_format="%d.%m.%Y",
    )
    return _read(spark, name)


@query(
    "load_day_partitions",
    "L8 R1 C3",
    EVENTS_SQL
    + """SELECT event_id, time, value FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-07 06:00:00') AND time < epoch(TIMESTAMP '2024-01-21')""",
)
def load_day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{new_database(spark)}.t"
    load_table(table(spark, sf_dir, "events"), name, time_col="ts", day_partitions=True, sort_by_time=True)
    columns = ["event_id", "time", "value"]
    return read_table(spark, name, columns, ("2024-01-07 06:00", "2024-01-21"), None)


@query("stream_load", "X1 L5", EVENTS_SQL + "SELECT * FROM ev")
def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as many files, one micro-batch each, folded as they come."""
    name = f"{new_database(spark)}.t"
    events, source = table(spark, sf_dir, "events"), scratch_path(spark, "source")
    events.repartition(24, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    running = stream_load(
        stream, name, scratch_path(spark, "stream"), "events", fold_every=8, time_col="ts"
    )
    running.awaitTermination()
    spark.catalog.refreshTable(name)
    return _read(spark, name)


@query(
    "load_other_session_zone",
    "C4 F1 R1",
    EVENTS_SQL
    + """SELECT event_id, time, value FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-07 06:00:00') AND time < epoch(TIMESTAMP '2024-01-21')""",
)
def load_other_session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded and read in a session set to another zone: times without a zone are UTC all the same."""
    tokyo = isolated_session(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"})
    name = f"{new_database(tokyo)}.t"
    load_table(table(tokyo, sf_dir, "events"), name, time_col="ts")
    return read_table(tokyo, name, ["event_id", "time", "value"], ("2024-01-07 06:00", "2024-01-21"))


@query(
    "load_declared_binary",
    "L10",
    "SELECT p_partkey, p_name AS raw, p_size AS size_in_map, p_brand AS brand, 1 AS time FROM part",
)
def load_declared_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, maps and records reach columns declared as such unchanged."""
    name = f"{new_database(spark)}.t"
    schema = declared_schema(
        ["p_partkey", "raw", "sizes", "about", "time"],
        ["bigint", "binary", "map(varchar, int)", "struct<brand:string>", "bigint"],
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").cast("binary").alias("raw"),
        F.create_map(F.lit("size"), "p_size").alias("sizes"),
        F.struct(F.col("p_brand").alias("brand")).alias("about"),
        F.lit(1).alias("time"),
    )
    load_table(part, name, schema=schema)
    return _read(spark, name).select(
        "p_partkey",
        F.col("raw").cast("string").alias("raw"),
        F.col("sizes")["size"].alias("size_in_map"),
        F.col("about.brand").alias("brand"),
        F.col("time").cast("int").alias("time"),
    )


@query(
    "load_rejects_lossy",
    "L4",
    "SELECT event_id, value FROM events WHERE value <> floor(value)",
)
def load_rejects_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with a fraction don't fit a column of whole numbers, and are set aside whole."""
    name = f"{new_database(spark)}.t"
    events = events_with_time(spark, sf_dir).select("event_id", "value", "time")
    whole = events.withColumn("value", F.when(F.col("event_id") % 5 == 0, F.floor("value")).otherwise(F.col("value")))
    both = whole.unionByName(events.where(F.col("event_id") % 5 == 0))
    load_table(both, name, validate=True, schema=declared_schema(["event_id", "value", "time"], ["bigint"] * 3))
    row = F.from_json("_row", "event_id BIGINT, value DOUBLE")
    return spark.table(f"{name}__rejects").select(row["event_id"].alias("event_id"), row["value"].alias("value"))


@query(
    "recast_nan",
    "L11 T8",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events""",
)
def recast_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that reads as not-a-number is no value once recast."""
    name = f"{new_database(spark)}.t"
    text = F.when(F.col("event_id") % 3 == 0, F.lit("NaN")).otherwise(F.col("value").cast("string"))
    load_table(table(spark, sf_dir, "events").select("event_id", text.alias("value")), name, add_time=False)
    recast_columns(spark, name, [("value", "double")])
    return _read(spark, name)


@query(
    "load_sessions_by_day",
    "L5 L8 C3",
    EVENTS_SQL
    + """SELECT event_id, time FROM ev
    WHERE time >= epoch(TIMESTAMP '2024-01-07 06:00:00') AND time < epoch(TIMESTAMP '2024-01-21')""",
)
def load_sessions_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeatable loads whose rows are divided by day, so that a time range opens few files."""
    name = f"{new_database(spark)}.t"
    events = events_with_time(spark, sf_dir).select("event_id", "time")
    for part in (0, 1, 2, 1):
        load_table(
            events.where(_part_of("event_id") == part), name, "append", load_id=f"part-{part}", day_partitions=True
        )
    return read_table(spark, name, time_range=("2024-01-07 06:00", "2024-01-21"))
