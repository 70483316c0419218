"""Summarise the physical plan of every registered query: exchanges (by
kind), sorts, windows, joins, and what reaches each Parquet scan (pruned
columns, pushed filters, partition filters). Writes markdown to stdout.

    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.plans import catalog  # noqa: E402
from keelson.session import get_session  # noqa: E402

KINDS = [("hash", r"Exchange hashpartitioning"), ("range", r"Exchange rangepartitioning"),
         ("single", r"Exchange SinglePartition"), ("roundrobin", r"RoundRobinPartitioning"),
         ("broadcast", r"BroadcastExchange"), ("sort", r"\bSort \["), ("window", r"\bWindow \["),
         ("topk", r"TakeOrderedAndProject"), ("smj", r"SortMergeJoin"),
         ("bhj", r"BroadcastHashJoin"), ("python", r"FlatMapGroupsInPandasWithState|ArrowEvalPython|FlatMapGroupsInPandas")]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    print("# Physical plans of the registered queries\n")
    print(f"Initial (pre-AQE) physical plans at `{sf}`, from `scripts/plan_report.py`. "
          "Streaming keys show the batch read of their output table; their stream plans "
          "are described in the README.\n")
    print("| query | " + " | ".join(k for k, _ in KINDS) + " |")
    print("|---|" + "---|" * len(KINDS))
    scans = {}
    for name, fn in catalog.queries().items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan)) for _, p in KINDS]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
        found = []
        for line in plan.splitlines():
            if "FileScan" in line or "Scan parquet" in line:
                m = {k: re.search(k + r": (\[.*?\]|struct<.*?>)", line)
                     for k in ("ReadSchema", "PushedFilters", "PartitionFilters")}
                loc = re.search(r"\[file:[^\]]*?/([^/\]]+?)(\]|,|$)", line)
                found.append((loc.group(1) if loc else "?",
                              *[(m[k].group(1) if m[k] else "") for k in m]))
        scans[name] = found
    print("\n## Scans\n")
    print("| query | table | read schema | pushed filters | partition filters |")
    print("|---|---|---|---|---|")
    for name, found in scans.items():
        for t, rs, pf, part in found:
            print(f"| {name} | {t} | `{rs[:120]}` | `{pf[:160]}` | `{part[:80]}` |")


if __name__ == "__main__":
    main()
