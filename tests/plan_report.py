"""Summarise the physical plans of the headline queries (PLANS.md).

    python tests/plan_report.py [--sf DIR] > PLANS.md
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan (\w+) \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>", plan)
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                                   plan)),
        "broadcast joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python stages": plan.count("MapInPandas") + plan.count("MapInArrow") + plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
        "scans": len(scans),
        "max cols read": max((len(re.findall(r"(?:^|,)\w+:", s[2])) for s in scans), default=0),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    from bench import HEADLINE
    from tesoro.session import build_session
    import __spark_entry__ as E
    from tesoro.plans import bindings
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan Catalyst chose
    qs = E.queries()
    # nothing is staged here, so every plan goes down to the tables
    bindings.stage = lambda df: df
    cols = ["shuffles", "broadcast joins", "sort-merge joins", "windows", "python stages", "scans",
            "max cols read", "cartesian"]
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tests/plan_report.py` on `{a.sf}` with AQE off (the static plan; at run time AQE")
    print("may coalesce partitions, switch a sort-merge join to broadcast, or split skewed partitions).")
    print("Intermediates that the queries stage once are inlined here, each time they are read, so the plans go")
    print("down to the tables.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name in HEADLINE:
        df = qs[name](spark, a.sf)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
