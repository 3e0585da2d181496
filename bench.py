"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8), one warm-up run and then
``$BENCH_RUNS`` (default 3) timed runs each; the time of a run is a full
execution into Spark's ``noop`` sink (every row computed, nothing
collected). Prints ONE JSON line: the metric is the sum over queries of
the median run time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from haulage.plans.catalog import queries  # noqa: E402
from haulage.session import get_session  # noqa: E402

HEADLINE = [
    "a03_lane_totals",
    "a01_yearly_totals",
    "a06_trade_balance",
    "t05_top8_outbound_per_state",
    "r04_route_costs",
    "r06_lane_efficiency",
    "a07_avg_haul",
    "e00_entity_rank",
    "k05_efficiency_mart_percent_rank_tier",
    "f04_statistical_features",
    "a10_basic_kpis",
    "a18_descriptive_statistics",
    "w04_latest_fuel_per_state",
    "s15_table_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                        extra={"spark.driver.memory": "16g"})
    qs = queries()
    times = {}
    for name in names:
        fn = qs[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
