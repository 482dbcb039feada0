"""Summarise the physical plan of every registered batch query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query: parquet scans with the number of columns read and whether
filters were pushed, exchanges (shuffles), join strategies, window and
Python operators, and whether every aggregate has a partial step. Plans
are the planned (pre-AQE) physical plans; AQE may still coalesce
partitions, split skewed joins or turn a shuffle join into a broadcast.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [\w.]*\[([^\]]*)\]", plan)
    reads = [len(cols.split(",")) for cols in scans]
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    return {
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "cols_read": ",".join(map(str, reads)) or "-",
        "pushed": pushed,
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast": len(re.findall(r"BroadcastExchange", plan)),
        "joins": ",".join(sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)))) or "-",
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
        "partial_aggs": len(re.findall(r"partial_", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tallyflow.plans.queries import BATCH_QUERIES, all_queries
    from tallyflow.session import build_session

    spark = build_session(shuffle_partitions=16)
    qs = all_queries()
    cols = ["scans", "cols_read", "pushed", "exchanges", "single_partition", "broadcast", "joins", "windows", "python", "partial_aggs"]
    print(f"# Physical plans at {sf_dir}\n")
    print(__doc__.split("\n\n", 2)[2].strip() + "\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name in BATCH_QUERIES:
        plan = qs[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
