"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then three times into the noop sink; the median counts. Queries named ``stored_*``
read a warehouse that is loaded before, untimed, as a user's queries would; the others derive their inputs each time.
``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the threads, ``BENCH_QUERIES`` (comma-separated) a selection.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tidemark.operators.latest import sales_fact
from tidemark.plans.mart import customer_cohorts
from tidemark.plans.refresh import live_mart
from tidemark.plans.upload import captured
from tidemark.schemas import SALES
from tidemark.session import configure
from workload.inputs import Tables
from workload.queries import QUERIES, published_store

STORED = {
    "stored_live_mart": live_mart,
    "stored_cohorts": lambda store: customer_cohorts(live_mart(store)),
    "stored_fact_rebuild": lambda store: sales_fact(store.table(SALES.history_table)),
    "stored_capture_sales": lambda store: captured(store, SALES, store.table(SALES.staging_table).count()),
}

HEADLINES = (
    "new_or_changed_strict",
    "new_or_changed_by_key",
    "scd2_events_same_day",
    "scd2_part",
    "latest_per_line",
    "fact_sales",
    "latest_order_label",
    "upsert_lines",
    "pit_customer",
    "pit_many_versions",
    "sales_mart",
    "customer_cohorts",
    "unmatched_facts",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [*HEADLINES, *STORED]
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    store = None
    if set(names) & set(STORED):
        store = published_store(Tables(spark, folder))
        store.stage(SALES.staging_table, store.table(SALES.history_table))
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            df = STORED[name](store) if name in STORED else QUERIES[name](spark, folder)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
