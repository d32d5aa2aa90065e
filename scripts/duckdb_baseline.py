"""Time the oracle SQL of every registered query on DuckDB (the reference's engine).

    python scripts/duckdb_baseline.py [sf_dir] [threads]

Prints one JSON line like bench.py.  Each query is run once to warm the
file cache, then timed (median of 3), fully materialised.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    from strata.plans.queries import ORACLE_SQL

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
    print(json.dumps({"metric": "duckdb_oracle_total_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf_dir": sf_dir, "threads": threads}))


if __name__ == "__main__":
    main()
