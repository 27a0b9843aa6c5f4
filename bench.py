"""Benchmark the query catalogue.

Runs every catalogue query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed
in full through the ``noop`` sink (all rows produced, nothing collected to
the driver); one warm-up pass, then the median of ``$BENCH_RUNS`` (default 5) timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _driver_memory() -> str:
    """Up to 8 GB, at most 60% of physical memory (local mode: driver = executor)."""
    try:
        with open("/proc/meminfo") as f:
            kb = int(next(line for line in f if line.startswith("MemTotal")).split()[1])
        return f"{max(1, min(8, int(kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tally.plans.catalogue import QUERIES
    from tally.session import build_session

    scratch = tempfile.mkdtemp(prefix="tally-bench-")
    conf = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", _driver_memory()),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
        "spark.local.dir": scratch,
    }
    conf.update(json.loads(os.environ.get("BENCH_CONF", "{}")))
    spark = build_session(f"local[{cpus}]", app_name="tally-bench",
                          shuffle_partitions=max(cpus, 4), extra_conf=conf)
    spark.sparkContext.setLogLevel("ERROR")

    names = only or list(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    failed = set()
    for name in names:          # warm-up: JIT, file listing, codegen caches
        try:
            run(name)
        except Exception as exc:          # record and go on: one line of JSON regardless
            print(f"{name} failed: {exc}", file=sys.stderr)
            failed.add(name)
    timings = {}
    for name in names:
        timings[name] = (None if name in failed
                         else round(statistics.median(run(name) for _ in range(runs)), 4))
    spark.stop()

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "catalogue_total_sec",
        "value": round(sum(v for v in timings.values() if v is not None), 4),
        "failed": sorted(failed),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
