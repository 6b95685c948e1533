"""Times every query of the catalogue; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables and ``BENCH_CPUS`` the number of cores. Each query
runs once after a short warm-up, and its whole result is computed and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fareflow.plans.catalogue import QUERIES
from fareflow.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the executors and compiles common code, so that the first query is timed like the rest.
    QUERIES["silver_trips"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
