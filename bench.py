"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; the last line is one JSON object.

Every query runs to its end into Spark's ``noop`` sink, loads included: a warm-up, then
``RUNS`` timed runs, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

RUNS = 3
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

#: What each figure stands for, by the name of its registered query.
HEADLINE = {
    "time_range_read": "read_table_projected",
    "daily_aggregate": "daily_summary",
    "pivot": "pivot_daily_average",
    "gap_filled_resample": "resample_orders_hourly",
    "validated_load": "load_validated",
    "append_by_name": "load_append_by_name",
    "row_index": "row_index",
    "stream_load": "stream_load",
    "join_partitioned": "join_partitioned",
    "arrays_to_text": "arrays_to_text",
}
#: Rows that the load in a query takes in, for a rate.
LOADED = {"validated_load": "orders"}


def main() -> None:
    from tidetable.plans import QUERIES
    from tidetable.session import get_spark

    work = tempfile.mkdtemp(prefix="bench-")
    spark = get_spark(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.checkpoint.dir": f"{work}/shared",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    for name, query in HEADLINE.items():
        took = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            QUERIES[query].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took[1:]), 3)
    rates = {
        f"{name}_rows_per_sec": round(spark.read.parquet(f"{SF_DIR}/{table}.parquet").count() / seconds[name])
        for name, table in LOADED.items()
    }
    spark.stop()
    out = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rates": rates,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
        "runs": RUNS,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
