"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data directory, ``BENCH_CPUS`` the local cores. Each query is
run once to warm up and then ``BENCH_RUNS`` times; the median counts. Results are fully
evaluated into a no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from barloom.catalog.queries import QUERIES
from barloom.session import local_session

HEADLINE = [
    "silver_timeseries", "silver_prices_daily", "gold_daily_features", "gold_item_metrics", "gold_price_features",
    "outlier_days", "item_statistics", "select_hybrid_force", "backtest_scores", "backtest_item_result",
    "backtest_ets_first", "backtest_ets", "leaderboard", "predict_batch", "incremental_gold", "holt_fixed",
    "upsert_table", "stream_silver",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus})
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))


if __name__ == "__main__":
    main()
