"""Summarise the executed (final adaptive) plan of every registered query.

Usage: python tools/plans.py [sf_dir] > PLANS.md
Each query is run once (collected) so that the plan shown is the one AQE
settled on; the table counts shuffles, broadcasts, join strategies and
partial aggregation, and lists what reaches each parquet scan.
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    # An adaptive plan prints its final and its initial form; keep the final one.
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]

    def n(pat):
        return len(re.findall(pat, plan))
    scans = sorted(set(
        (re.sub(r"#\d+L?", "", cols), re.sub(r"#\d+L?", "", pushed))
        for cols, pushed in re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)))
    return {
        "shuffles": n(r"Exchange (?:hash|range|round|single)"),
        "reused": n(r"ReusedExchange"),
        "broadcasts": n(r"BroadcastExchange"),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                                 r"BroadcastNestedLoopJoin|CartesianProduct)", plan)))) or "-",
        "partial agg": "yes" if re.search(r"partial_", plan) else "-",
        "group limit": "yes" if "WindowGroupLimit" in plan else "-",
        "scans": "; ".join(f"[{c}] pushed: {p or '-'}" for c, p in scans),
    }


def main() -> None:
    from clickflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    from clickflow.plans import QUERIES
    print(f"# Executed plans ({sf}, local[8], 8 shuffle partitions, AQE on)\n")
    print("Generated by `tools/plans.py` from each query's final adaptive plan (after running it).  "
          "`shuffles` counts exchanges executed (a reused one is listed separately); `broadcasts` and joins are "
          "Spark's own size-based choices.\n")
    print("| query | shuffles | reused | broadcasts | joins | partial agg | group limit | parquet scans |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['joins']} | "
              f"{s['partial agg']} | {s['group limit']} | {s['scans']} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
