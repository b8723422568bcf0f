"""Time every query and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores, BENCH_RUNS the number of
timed runs after one warm-up. A result is written to Spark's ``noop`` sink, so all rows and columns
are computed and none are brought to the driver. Storing the input log, which queries share, is
timed apart as ``ingest_seconds``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ferrylog.plans.inputs import Inputs
from ferrylog.plans.queries import QUERIES
from ferrylog.plans.streams import STREAMS
from ferrylog.session import build_session


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    ingest = timed(lambda: Inputs(spark, folder).log_folder())
    seconds = {}
    for name in wanted:
        def run(query=QUERIES[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        if name in STREAMS:
            seconds[name] = round(timed(run), 3)
            continue
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)

    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
                "ingest_seconds": round(ingest, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
