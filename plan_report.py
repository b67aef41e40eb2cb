"""Physical-plan summary of the headline queries: scans, shuffles, joins, pushdown.

Usage: python plan_report.py [sf_dir] > PLANS.md
Plans are taken after execution (``noop`` write), so AQE's final plan is shown.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench import HEADLINE  # noqa: E402

OPS = ("Scan parquet", "Scan csv", "Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
       "ShuffledHashJoin", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "Sort",
       "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def summarize(df) -> tuple[Counter, list[str]]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts: Counter = Counter()
    scans = []
    for line in plan.splitlines():
        node = re.sub(r"^[\s:+\-|*]*(\(\d+\)\s*)?", "", line).split("(")[0].split(" ")[0]
        if node == "FileScan":
            fmt = line.split("FileScan", 1)[1].split()[0]
            counts[f"Scan {fmt}"] += 1
            loc = re.search(r"Location: \w+(?:\([^)]*\))?\[([^\]]+)\]", line)
            pf = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
            pu = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            tbl = loc.group(1).rstrip("/").split("/")[-1] if loc else "?"
            scans.append(f"{tbl}: partition filters [{pf.group(1) if pf else ''}], "
                         f"pushed filters [{(pu.group(1) if pu else '')[:110]}]")
        elif node in OPS:
            counts[node] += 1
    return counts, scans


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bdxguard.plans.catalog import QUERIES
    from bdxguard.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=16)
    print(f"# Physical plans of the headline queries ({os.path.basename(sf_dir)}, final AQE plans)\n")
    print("Counts of physical operators per query (silver/metadata tables are written once per input and scanned).\n")
    cols = ("Scan parquet", "Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
            "ObjectHashAggregate", "SortAggregate", "Window")
    print("| query | " + " | ".join(cols) + " | python UDF / cartesian |")
    print("| --- " * (len(cols) + 2) + "|")
    details = []
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        c, scans = summarize(df)
        bad = c["BatchEvalPython"] + c["ArrowEvalPython"] + c["CartesianProduct"] + c["BroadcastNestedLoopJoin"]
        print(f"| {name} | " + " | ".join(str(c[k]) for k in cols) + f" | {bad} |")
        details.append((name, scans))
    print("\n## Scans and pushdown\n")
    for name, scans in details:
        print(f"- **{name}**")
        for s in sorted(set(scans)):
            print(f"  - {s}")
    spark.stop()


if __name__ == "__main__":
    main()
