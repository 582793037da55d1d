"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (every row computed, nothing
collected). Before timing, every headline query runs once on the smallest table set
(untimed warm-up: JVM JIT and Spark's generated-code cache, the usual benchmark
practice); the landing of the raw documents at the measured scale, once per run, is timed
and reported as ``land_raw``. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from isobar.plans.registry import QUERIES  # noqa: E402
from isobar.session import build_session  # noqa: E402
from isobar.sources.driver_tables import raw_forecasts  # noqa: E402

HEADLINE = [
    "flatten_hourly",
    "dedupe_latest",
    "rolling_mean_3",
    "fct_hourly",
    "fct_daily",
    "daily_summary",
    "temperature_anomalies",
    "hourly_trend",
    "latest_kpis",
    "dq_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = sys.argv[1:] or HEADLINE
    # warm-up (not timed): the same plans on the smallest tables
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for n in names:
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    # one-time landing of the raw forecast documents derived from ``events``
    t0 = time.perf_counter()
    raw_forecasts(spark, sf_dir)  # lands once per application
    times["land_raw"] = round(time.perf_counter() - t0, 3)
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
