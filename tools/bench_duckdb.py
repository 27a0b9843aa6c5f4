"""Time the oracle SQL (the source reports' own SQL shape) on DuckDB.

A single-node stand-in for the reference's engine, at the same scale factor
as bench.py. Prints one JSON line. Usage: python tools/bench_duckdb.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tally.plans.oracle import ORACLE_SQL  # noqa: E402

TABLES = ["customer", "part", "orders", "lineitem", "events"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(os.environ.get("BENCH_CPUS", "8"))
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    timings = {}
    for name, sql in ORACLE_SQL.items():
        con.execute(sql).fetchall()
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "sf_dir": sf_dir,
                      "total": round(sum(timings.values()), 4), "queries": timings}))


if __name__ == "__main__":
    main()
