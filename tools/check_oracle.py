"""Run registered queries against their DuckDB twins.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tests"))

from harness import compare, duck  # noqa: E402

from marketlake.plans.registry import all_oracles, all_queries  # noqa: E402
from marketlake.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and os.path.isdir(args[0]):
        sf_dir = args.pop(0)
    qs = all_queries()
    oracles = all_oracles()
    names = args or sorted(qs)
    spark = build_session("local[8]", shuffle_partitions=8, driver_memory="8g")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, sf_dir)
            if n in oracles:
                ok, msg = compare(df, oracles[n], con)
            else:
                cnt = df.count()
                ok, msg = True, f"{cnt} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
            traceback.print_exc(limit=2)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
