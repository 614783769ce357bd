"""Benchmark the registered queries; print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (timed runs per query, default 3),
``BENCH_QUERIES`` (comma-separated subset, default all), ``BENCH_EVENT_LOG``
(a folder: write Spark's event log there for ``tools/stage_times.py``).

Each run rebuilds the DataFrame from the files and executes it completely
with the ``noop`` sink (nothing is collected to the driver), so a timing
covers listing, planning, scanning, shuffles and any writes the query makes.
The reported time per query is the median of the timed runs after one
warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cartwheel.plans.registry import QUERIES
    from cartwheel.session import build_session, release_scratch

    scratch = tempfile.mkdtemp(prefix="cartwheel-bench-")
    extra = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    }
    event_log = os.environ.get("BENCH_EVENT_LOG")
    if event_log:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(
        f"local[{cpus}]",
        app_name="cartwheel-bench",
        shuffle_partitions=cpus,
        extra=extra,
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    names = wanted or list(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        release_scratch(spark)
        return took

    per_query: dict[str, float] = {}
    for name in names:
        run(name)  # warm-up: JIT, file listing caches, class loading
        per_query[name] = round(statistics.median(run(name) for _ in range(runs)), 4)

    total = round(sum(per_query.values()), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_sec",
                "value": total,
                "unit": "sec",
                "queries": per_query,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
