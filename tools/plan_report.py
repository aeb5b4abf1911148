"""Run every registered query and summarise its final (adaptive) physical plan.

usage: python tools/plan_report.py [sf_dir] [key ...]   -> markdown table on stdout

Per query: shuffle exchanges, broadcasts, exchanges reused, whether any exchange
gathers everything into one partition, nested-loop / cartesian joins, Python
stages (Arrow UDF / mapInPandas / mapInArrow / applyInPandas), pushed filters,
and the partial window-group limit of top-k queries.

Queries that write (streaming, ingestion, DDL) return a read of what they wrote;
their report covers that read, not the jobs that produced it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans.registered import QUERIES  # noqa: E402
from quayside.session import build_session  # noqa: E402


def _final_only(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` subtree (adaptive plans print both forms)."""
    kept, skip_below = [], None
    for line in plan.splitlines():
        start = next((i for i, ch in enumerate(line) if ch.isalnum() or ch == "="), len(line))
        if skip_below is not None:
            if start > skip_below:
                continue
            skip_below = None
        if "== Initial Plan ==" in line:
            skip_below = line.index("== Initial Plan ==") - 1  # its subtree starts in that column
            continue
        kept.append(line)
    return "\n".join(kept)


def _summary(plan: str) -> dict:
    plan = _final_only(plan)

    def count(pattern: str) -> int:
        return len(re.findall(pattern, plan))

    return {
        "shuffles": count(r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)"),
        "broadcasts": count(r"(?<!Reused)BroadcastExchange"),
        "reused": count(r"ReusedExchange"),
        "single_partition": count(r"Exchange SinglePartition"),
        "nested_loop_or_cartesian": count(r"BroadcastNestedLoopJoin|CartesianProduct"),
        "python": count(r"ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|BatchEvalPython"),
        "pushed_filters": count(r"PushedFilters: \[[^\]]+\]"),
        "group_limit": count(r"WindowGroupLimit .*Partial"),
    }


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    keys = args or list(QUERIES)
    spark = build_session(shuffle_partitions=16, app="quayside-plans")
    cols = ["shuffles", "broadcasts", "reused", "single_partition", "nested_loop_or_cartesian", "python",
            "pushed_filters", "group_limit"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for key in keys:
        df = QUERIES[key](spark, sf_dir)
        df.collect()
        s = _summary(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{key}` | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
