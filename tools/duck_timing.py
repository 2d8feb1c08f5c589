"""Time every oracle query in DuckDB on one scale factor (single-node reference point).

usage: python tools/duck_timing.py [sf_dir]   -> one JSON line, median of 3 per query
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from hourgrid.oracle import oracle_sql  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    out = {}
    for name, sql in oracle_sql().items():
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.sql(sql).fetchall()
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 3)
    print(json.dumps({"engine": "duckdb " + duckdb.__version__, "sf_dir": sf_dir,
                      "threads": con.execute("SELECT current_setting('threads')").fetchall()[0][0],
                      "total": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main()
