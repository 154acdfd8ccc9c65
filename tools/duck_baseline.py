"""Time every oracle SQL in DuckDB (median of N) on one scale factor and
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tests"))

from harness import duck  # noqa: E402

from marketlake.plans.registry import all_oracles  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(os.environ.get("DUCK_THREADS", "8"))
    reps = int(os.environ.get("DUCK_REPS", "3"))
    con = duck(sf_dir)
    con.execute(f"SET threads = {threads}")
    out = {}
    for name, sql in sorted(all_oracles().items()):
        con.execute(sql).fetchall()
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "sf_dir": sf_dir, "total": round(sum(out.values()), 3),
                      "queries": out}))


if __name__ == "__main__":
    main()
