"""Time the queries at one scale: each runs whole, into a sink that discards the rows. Prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS (timed runs after one warm-up, the median counts) come from the environment;
names on the command line limit the run to those queries.
"""

from __future__ import annotations

import importlib.util
import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from quillbar.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def load_queries():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.queries()


def once(spark, fn) -> float:
    start = time.perf_counter()
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    timings = {}
    for name, fn in load_queries().items():
        if wanted and name not in wanted:
            continue
        once(spark, fn)
        timings[name] = round(statistics.median(once(spark, fn) for _ in range(RUNS)), 4)
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total query time", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
