"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    runs per query, of which the median counts (default 3)

Each run computes the whole result and discards the rows, so neither collecting
nor printing is timed. Steps a query takes while it is built, such as writing
and rereading a table, are part of its time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from tallyloom.plans.registry import QUERIES, runner
from tallyloom.session import build_session


def main(names: list[str]) -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "tallyloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyloom-bench-"),
        },
    )

    def once(name: str) -> float:
        start = time.perf_counter()
        runner(name)(spark, root).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = names or list(QUERIES)
    once(names[0])  # starts the executor threads and loads classes
    times = {name: round(statistics.median(once(name) for _ in range(runs)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
