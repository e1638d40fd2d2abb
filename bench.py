"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row computed,
nothing collected); the best of ``BENCH_REPEAT`` (default 3) runs counts. Prints one JSON
line: ``{"metric", "value" (sum of query seconds), "unit", "queries", "sf", ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_mean",
    "interpolate_hourly",
    "interpolate_hourly_users",
    "unnest_rates",
    "ticks",
    "forecast_seasonal",
    "forecast_ar1",
    "forecast_report",
    "serve_stat",
    "serve_detail_arima",
    "stream_hourly_mean",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE

    from ratecast.plans import model_queries, queries, ticks_queries
    from ratecast.session import local_session

    spark = local_session(cpus, max(8, 2 * cpus), app="ratecast-bench")
    qs = queries()

    def run(name: str) -> None:
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()

    run("hourly_mean")  # warm-up: JVM, codegen caches, file listing
    times: dict[str, float] = {}
    # forecasts are written once and then read: writing all tables is timed apart from the queries that read them
    t0 = time.perf_counter()
    for model in (tables := model_queries._tables(spark, sf_dir).frames):
        tables[model]
    times["write_forecast_tables"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    ticks_queries._requests(spark, sf_dir)
    times["write_oracle_requests"] = round(time.perf_counter() - t0, 3)
    for n in names:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(n)
            best = min(best, time.perf_counter() - t0)
        times[n] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
