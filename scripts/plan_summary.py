"""Summarize the physical plan of every registered query of the core into a Markdown table.

The plan that is printed is the one that ran: its own RDD is executed, and of the adaptive
plan only the final part is counted.

Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    count = lambda pat: len(re.findall(pat, plan))
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    return {
        "shuffles": count(r"Exchange hashpartitioning") + count(r"Exchange rangepartitioning")
                    + count(r"Exchange RoundRobin"),
        "single": count(r"Exchange SinglePartition"),
        "broadcast": count(r"BroadcastExchange"),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                                r"BroadcastNestedLoopJoin|CartesianProduct) ?\w*", plan)))) or "-",
        "reused": count(r"ReusedExchange") + count(r"ReusedSubquery"),
        "topn": "yes" if "TakeOrderedAndProject" in plan else "",
        "wgl": "partial+final" if "Partial" in plan and "WindowGroupLimit" in plan else "",
        "python": "YES" if re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan) else "none",
        "scans": len(scans),
        "max_cols": max((len(s.split(",")) for s in scans), default=0),
    }


def final_part(plan: str) -> str:
    """The final part of every adaptive plan in ``plan`` (subqueries have their own)."""
    final = re.sub(r"== Initial Plan ==.*?(?=\n\S|\Z)", "", plan, flags=re.S)
    assert not final.startswith("AdaptiveSparkPlan isFinalPlan=false"), "not executed"
    return final


def main():
    from clipstat.session import build_session
    from clipstat.plans import registry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | shuffle exchanges | single-partition (global agg) | broadcasts | joins | reused | top-n | "
          "window limit | Python | parquet scans | max cols read |")
    print("|---|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in registry.QUERIES.items():
        df = fn(spark, sf_dir)
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        plan = final_part(execution.executedPlan().toString())
        s = summarize(plan)
        print(f"| `{name}` | {s['shuffles']} | {s['single']} | {s['broadcast']} | {s['joins']} | {s['reused']} | "
              f"{s['topn']} | {s['wgl']} | {s['python']} | {s['scans']} | {s['max_cols']} |")


if __name__ == "__main__":
    main()
