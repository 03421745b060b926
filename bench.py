"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the data, ``BENCH_CPUS`` the number of local cores. A query's time
covers everything from its call to the last row, the jobs that it runs to plan included;
the stored raw snapshots that several queries read are written before.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daymark.session import configure  # noqa: E402
from workload.fixtures import landed, raw_events, raw_lineitem  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "parse_grouped_long",
    "parse_decimal_comma",
    "html_rows",
    "html_pages_ordered",
    "latest_capture",
    "summarise_snapshot",
    "compare_snapshots",
    "compare_spread",
    "summarise_all_dates",
    "compare_all_dates",
    "summarise_all_months",
    "compare_all_months",
    "refined_roundtrip",
    "dynamic_overwrite",
    "run_latest",
    "sql_over_registered",
    "stream_ingest",
)
ROUNDS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("daymark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for source in (raw_events, raw_lineitem):
        landed(spark, sf_dir, source)
    times: dict[str, float] = {}
    for _ in range(ROUNDS):  # the first round also compiles; the better one counts
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = round(time.perf_counter() - start, 3)
            times[name] = min(seconds, times.get(name, seconds))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
