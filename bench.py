"""Benchmark: run the query catalogue at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is executed to completion with the ``noop`` sink (all partitions computed, nothing
collected to the driver), twice: the first (cold) run includes plan analysis and code generation
for expressions not seen before, the second (warm) run is the steady state of a job that runs
repeatedly. ``value`` and ``queries`` are the warm wall times; ``cold`` lists the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from epistand.plans.catalogue import queries  # noqa: E402
from epistand.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="epistand-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    catalogue = queries()
    names = only or sorted(catalogue)
    # Warm-up: first query compiles the shared code paths; not counted.
    catalogue["fiscal_year_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    for name in names:
        # Outside the timed region: a JVM collection lets Spark's cleaner drop the broadcasts,
        # shuffle files and checkpoints of earlier queries, so each query starts from the same state.
        spark.sparkContext._jvm.System.gc()
        for store in (cold, times):
            t0 = time.perf_counter()
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            store[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "catalogue_total_wall_warm", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "cold_total": round(sum(cold.values()), 3),
                      "cold": cold}))


if __name__ == "__main__":
    main()
