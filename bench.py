"""Times every query on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line.

Each query runs once unmeasured and once measured; its whole result is produced and
thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wardlens.session import local_session
from workload import QUERIES


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    only = sys.argv[1:]
    spark = local_session(cores, app="bench")
    seconds = {}
    for name in sorted(only or QUERIES):
        run(QUERIES[name], spark, folder)
        seconds[name] = round(run(QUERIES[name], spark, folder), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
