"""Summarise the physical plans of registered queries (from ``explain``):
shuffles, broadcasts, join strategies, aggregates, windows and the filters
pushed into parquet scans. Writes a markdown table to stdout.

    python tools/plan_summary.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adpulse.plans.registry import load_all  # noqa: E402
from adpulse.session import get_spark  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash_aggs": r"(Hash|ObjectHash|SortAggregate)Aggregate",
    "windows": r"\bWindow\b",
    "python": r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)",
}


def summarise(plan: str) -> dict:
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    out["pushed_filters"] = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = get_spark()
    reg = load_all()
    names = names or [n for n, q in reg.items() if q.headline]
    cols = ["shuffles", "broadcasts", "bhj", "smj", "nested_loop", "hash_aggs", "windows",
            "python", "pushed_filters"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for n in names:
        df = reg[n].build(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {n} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
