"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Every query runs
in full (all rows and columns are computed, none are kept).
"""

from __future__ import annotations

import json
import os
import time

from registry.queries import QUERIES
from tickerloom.session import build

HEADLINES = [
    "hourly_trends",
    "clean_and_process",
    "dedup_first",
    "collect_posts",
    "market_summary",
    "rolling_sentiment",
    "term_frequency",
    "build_vocabulary",
    "tfidf_momentum",
    "stream_hourly",
    "full_signals",
    "stage_metrics",
]


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    spark = build("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(4 * int(cpus)),
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(tables.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
