"""Queries that shape and coerce columns (C1, C4-C11, T*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.operators import (
    add_row_index,
    build_time,
    coerce,
    convert_time,
    drop_null_columns,
    format_dates,
    key_first,
    normalise_names,
    parse_dates,
    shape_result,
    shift_timezone,
)
from tidetable.plans.registry import EVENTS_SQL, events_with_time, query, table
from tidetable.session import isolated_session


@query(
    "normalise_names",
    "C1",
    """SELECT p_partkey AS part_key__, p_name AS name, p_retailprice AS retail_price__usd_
    FROM part""",
)
def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return normalise_names(part.toDF("Part-Key é", "NAME", "Retail Price (USD)"))


@query(
    "time_from_datetime",
    "C4",
    "SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS time FROM events",
)
def time_from_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_time(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")


@query(
    "time_from_text",
    "C4",
    "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS time FROM orders",
)
def time_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return build_time(orders.select("o_orderkey", F.col("o_orderdate").cast("string").alias("at")), "at")


@query(
    "time_from_key",
    "C4 C11",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
    CAST(epoch(l_shipdate) AS BIGINT) AS time FROM lineitem""",
)
def time_from_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("shipped"))
    return key_first(format_dates(build_time(lines, time_key="shipped"), "%Y-%m-%d"), "shipped")


@query(
    "row_index",
    "C5",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_custkey DESC, o_orderkey) - 1 AS index
    FROM orders""",
)
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status holds about a third of all orders, so the leading key is hot."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    indexed = add_row_index(orders, [F.col("o_orderstatus"), F.col("o_custkey").desc(), F.col("o_orderkey")])
    return indexed.select("o_orderkey", "index")


@query(
    "format_dates",
    "C6",
    """SELECT event_id, strftime(ts, '%d/%b/%Y %H:%M:%S %j week %V') AS ts FROM events""",
)
def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_dates(table(spark, sf_dir, "events").select("event_id", "ts"), "%d/%b/%Y %H:%M:%S %j week %V")


@query(
    "parse_dates_units",
    "C7",
    """SELECT event_id,
    epoch_us(date_trunc('day', ts)) AS d, epoch_us(date_trunc('second', ts)) AS s,
    epoch_us(date_trunc('milliseconds', ts)) AS ms, epoch_us(ts) AS us, epoch_us(ts) AS ns,
    epoch_us(date_trunc('minute', ts)) AS txt, epoch_us(ts) AS iso FROM events""",
)
def parse_dates_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("ts").cast("timestamp")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_date(F.to_date(stamp)).alias("d"),
        F.unix_seconds(stamp).alias("s"),
        F.unix_millis(stamp).alias("ms"),
        F.unix_micros(stamp).alias("us"),
        (F.unix_micros(stamp) * 1000 + 999).alias("ns"),
        F.date_format(stamp, "dd/MM/yyyy HH:mm").alias("txt"),
        stamp.cast("string").alias("iso"),
    )
    units = {"d": "D", "s": "s", "ms": "ms", "us": "us", "ns": "ns", "txt": "%d/%m/%Y %H:%M"}
    parsed = parse_dates(parse_dates(raw, units), ["iso"])
    return parsed.select("event_id", *[F.unix_micros(c).alias(c) for c in [*units, "iso"]])


@query(
    "time_zone_shift",
    "C8 C9",
    EVENTS_SQL
    + """SELECT event_id, strftime(make_timestamp(time * 1000000) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS time
    FROM ev""",
)
def time_zone_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = shift_timezone(convert_time(events_with_time(spark, sf_dir)), "Asia/Tokyo")
    return shown.select("event_id", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"))


@query(
    "convert_time_text",
    "C8",
    "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS time FROM orders",
)
def convert_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    text = orders.select("o_orderkey", F.col("o_orderdate").cast("string").alias("time"))
    return convert_time(text).withColumn("time", F.unix_seconds("time"))


def _tokyo(spark: SparkSession) -> SparkSession:
    return isolated_session(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"})


def _micros_of_day_and_time(stamp: str):
    """Digits of a timestamp without zone, which no session's zone changes."""
    return F.regexp_replace(F.col(stamp).cast("string"), r"[^0-9]", "").substr(1, 14)


@query(
    "parse_dates_other_session_zone",
    "C7",
    """SELECT event_id, epoch_us(ts) AS iso, epoch_us(date_trunc('minute', ts)) AS txt,
    epoch_us(ts) - 9 * 3600000000 AS zoned, epoch_us(ts) AS ntz, epoch_us(date_trunc('day', ts)) AS day FROM events""",
)
def parse_dates_other_session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, dates and times without zone are UTC in a session of another zone too."""
    iso = F.col("ts").cast("string")
    raw = table(_tokyo(spark), sf_dir, "events").select(
        "event_id",
        iso.alias("iso"),
        F.date_format("ts", "dd/MM/yyyy HH:mm").alias("txt"),
        F.concat(iso, F.lit("+09:00")).alias("zoned"),
        F.col("ts").alias("ntz"),
        F.to_date("ts").alias("day"),
    )
    parsed = parse_dates(parse_dates(raw, {"txt": "%d/%m/%Y %H:%M"}), ["iso", "zoned", "ntz", "day"])
    return parsed.select("event_id", *[F.unix_micros(c).alias(c) for c in ("iso", "txt", "zoned", "ntz", "day")])


@query(
    "convert_time_other_session_zone",
    "C8",
    "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS time FROM orders",
)
def convert_time_other_session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(_tokyo(spark), sf_dir, "orders")
    text = orders.select("o_orderkey", F.col("o_orderdate").cast("string").alias("time"))
    return convert_time(text).withColumn("time", F.unix_seconds("time"))


@query(
    "time_zone_shift_other_session_zone",
    "C9",
    EVENTS_SQL
    + """SELECT event_id, strftime(make_timestamp(time * 1000000) - INTERVAL 5 HOUR, '%Y%m%d%H%M%S') AS time FROM ev""",
)
def time_zone_shift_other_session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January in New York, asked for in Tokyo."""
    shown = shift_timezone(convert_time(events_with_time(_tokyo(spark), sf_dir)), "America/New_York")
    return shown.select("event_id", _micros_of_day_and_time("time").alias("time"))


@query(
    "drop_null_columns",
    "C10",
    """SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 1 END AS late
    FROM orders""",
)
def without_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey").alias("last"))
    wide = orders.crossJoin(F.broadcast(last)).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") == F.col("last"), 1).alias("late"),
        F.when(F.col("o_orderkey") < 0, F.col("o_orderstatus")).alias("never"),
        F.lit(float("nan")).alias("not_a_number"),
        F.lit(None).alias("untyped"),
    )
    return drop_null_columns(wide)


@query(
    "shape_result_table",
    "C8 C9 C10 C11",
    EVENTS_SQL
    + """SELECT strftime(make_timestamp((time - time % 86400) * 1000000) + INTERVAL 9 HOUR, '%Y-%m-%d %H') AS time,
    count(*) AS n FROM ev GROUP BY 1""",
)
def shape_result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = events_with_time(spark, sf_dir).groupBy((F.col("time") - F.col("time") % 86400).alias("time"))
    result = days.agg(F.count(F.lit(1)).alias("n"), F.max(F.lit(None).cast("string")).alias("nothing"))
    shown = shape_result(result, dropna=True, timezone="Asia/Tokyo")
    return shown.withColumn("time", F.date_format("time", "yyyy-MM-dd HH"))


@query(
    "coerce_numbers",
    "T1 T2",
    """SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS i, CAST(l_linenumber AS BIGINT) AS b,
    CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS f, l_tax AS d FROM lineitem""",
)
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("i"),
        F.col("l_linenumber").cast("tinyint").alias("b"),
        F.col("l_discount").cast("float").alias("f"),
        F.col("l_tax").alias("d"),
    )
    return coerce(lines)


@query(
    "coerce_booleans",
    "T3",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN value > 50 THEN 'true' ELSE 'false' END AS big
    FROM events""",
)
def coerce_booleans(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = F.when(F.col("event_type") != "error", F.col("value") > 50)
    return coerce(table(spark, sf_dir, "events").select("event_id", big.alias("big")))


@query("coerce_text", "T4", "SELECT conv_id, turn, nullif(role, 'user') AS role, text FROM conversations")
def coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations")
    return coerce(talk.withColumn("role", F.nullif("role", F.lit("user"))))


@query(
    "coerce_other_to_text",
    "T7",
    """SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS stamp, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price,
    '{"k":' || CAST(o_custkey AS VARCHAR) || ',"s":"' || o_orderstatus || '"}' AS record,
    base64(encode(o_orderstatus)) AS bytes FROM orders""",
)
def coerce_other_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.col("o_orderdate").alias("stamp"),
            F.to_date("o_orderdate").alias("day"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
            F.struct(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s")).alias("record"),
            F.encode("o_orderstatus", "UTF-8").alias("bytes"),
        )
    )


@query(
    "coerce_nan",
    "T8",
    """SELECT event_id, CASE WHEN value < 100 THEN NULL WHEN value > 200 THEN 'Infinity'::DOUBLE
    WHEN value > 190 THEN '-Infinity'::DOUBLE ELSE value END AS v FROM events""",
)
def coerce_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    special = (
        F.when(value < 100, F.lit(float("nan")))
        .when(value > 200, F.lit(float("inf")))
        .when(value > 190, F.lit(float("-inf")))
        .otherwise(value)
    )
    return coerce(table(spark, sf_dir, "events").select("event_id", special.alias("v")))


@query(
    "arrays_to_text",
    "T5",
    "SELECT l_orderkey, l_linenumber, CAST([l_orderkey, l_partkey, l_suppkey] AS VARCHAR) AS keys FROM lineitem",
)
def arrays_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.array("l_orderkey", "l_partkey", "l_suppkey").alias("keys")
    rows = coerce(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", keys))
    return rows.withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


@query(
    "arrays_widened",
    "T2 T6",
    "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, CAST(label AS BIGINT) AS label FROM embeddings",
)
def arrays_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(table(spark, sf_dir, "embeddings"), keep_arrays=True)


@query(
    "arrays_cleaned",
    "T6",
    """SELECT vec_id, len(embedding) AS n, len(list_filter(embedding, lambda x: x < 0)) AS n_null,
    list_max(list_filter(embedding, lambda x: x >= 0))::DOUBLE AS top, 2 AS n_words, 1 AS null_words
    FROM embeddings""",
)
def arrays_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: F.when(x < 0, F.lit(float("nan"))).otherwise(x)).alias("e"),
        F.array(F.lit("nan"), F.col("label").cast("string")).alias("w"),
    )
    clean = coerce(dirty, keep_arrays=True)

    def nulls(name: str):
        return F.size(F.filter(name, lambda x: x.isNull())).cast("bigint")

    return clean.select(
        "vec_id",
        F.size("e").cast("bigint").alias("n"),
        nulls("e").alias("n_null"),
        F.array_max("e").alias("top"),
        F.size("w").alias("n_words"),
        nulls("w").cast("int").alias("null_words"),
    )
