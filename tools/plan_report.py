"""Summarise the physical plan of every registered query (after AQE has
run) into PLANS.md: shuffles, broadcasts, windows, Python stages, and the
filters / columns pushed into each parquet scan."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from marketlake.plans.registry import all_queries  # noqa: E402
from marketlake.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\n]*?PushedFilters: ([^\n]*?), ReadSchema: (struct<[^\n]*>)", plan)
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "python": len(re.findall(r"MapIn(?:Pandas|Arrow)|FlatMap(?:Co)?GroupsIn(?:Pandas|Arrow)|ArrowEvalPython|BatchEvalPython", plan)),
        "scans": scans,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, driver_memory="8g",
                          extra={"spark.sql.maxMetadataStringLength": "400"})
    qs = all_queries()
    lines = ["# Physical plans of the registered queries", "",
             f"Generated by `tools/plan_report.py {sf_dir}` (physical plans before AQE re-planning; at run time AQE",
             "may turn small shuffled joins into broadcasts and coalesce partitions).",
             "Shuffles = hash/range/single exchanges; Python = Arrow-batched stages. What a query wrote before its last plan",
             "(checkpoints, stored tables, streams) is not counted.", "",
             "| query | shuffles | broadcasts | windows | python | scans: pushed filters / read schema |", "|---|---|---|---|---|---|"]
    for name in sorted(qs):
        if name in ("q_hmm_fit", "q_hmm_fit_by_type"):
            lines.append(f"| {name} | iterative (see operators/hmm.py) | | | | |")
            continue
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        scans = "<br>".join(f"{f} {sch[:90]}" for f, sch in s["scans"][:4])
        lines.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['windows']} | {s['python']} | {scans} |")
    with open(os.path.join(os.path.dirname(__file__), "..", "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
