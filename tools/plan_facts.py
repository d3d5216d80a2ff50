"""Execute registered queries and summarise their final (AQE) physical plans:
file scans per table, shuffles, reused stages, join strategies, partial
top-k limits and pushed filters.

    python tools/plan_facts.py [sf_dir] [key ...]
    python tools/plan_facts.py /root/testdata/sf0.1 page_jump_ratio --show
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens import registry  # noqa: E402
from shoplens.session import get_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def facts(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet .*?Location: InMemoryFileIndex\(1 paths\)\[[^\]]*/(\w+)\.parquet\]", plan)
    per_table = {}
    for t in scans:
        per_table[t] = per_table.get(t, 0) + 1
    return {
        "scans": per_table,
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "reused": plan.count("Reused"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "partial_topk": plan.count(", Partial"),
        "pushed_filters": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))[:3],
    }


def main(argv):
    args = [a for a in argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    keys = args[1:] or list(registry.queries())
    spark = get_session(master="local[8]", shuffle_partitions=16)
    for k in keys:
        plan = final_plan(registry.queries()[k](spark, sf_dir))
        print(k, facts(plan))
        if "--show" in argv:
            print(plan)


if __name__ == "__main__":
    main(sys.argv)
