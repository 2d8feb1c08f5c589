"""Benchmark: headline jobs on one scale factor, one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3; the median of the warm runs is reported),
     BENCH_QUERIES (comma list; default all registered queries).
Each run builds the query and executes it to completion with the no-op sink
(every row is produced, nothing is collected to the driver).  The cache is
cleared before every run, so tables a query persists for its own reuse are
rebuilt each time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourgrid.queries import queries  # noqa: E402
from hourgrid.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    registry = queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(registry)
    spark = local_session(cpus, shuffle_partitions=cpus)

    def run(name: str) -> float:
        # no run may read data persisted by an earlier run of the same plan
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(names[0])  # JVM / code-cache warm-up, not reported
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
        "shuffle_partitions": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
