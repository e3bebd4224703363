"""Headline queries, timed end to end (planning included) and written to a sink that keeps nothing.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallysheet.queries import queries  # noqa: E402

HEADLINE = (
    "extract_sales",
    "attach_accounts",
    "asof_window",
    "asof_array",
    "asof_backward",
    "price_at_sale",
    "fct_sales",
    "fct_rollup",
    "fct_mart_table",
    "backfill_months",
    "replace_month_roundtrip",
    "dq_declared_staging",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    # One untimed run of the fact build, so that the first queries do not carry class loading.
    known["fct_rollup"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
