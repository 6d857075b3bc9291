"""Physical-plan summary of registered queries (after execution, so the
adaptive plan is final): scans per table with pushed filters, shuffles,
join strategies, windows. ``python -m innspark.plans.plan_report [sf_dir]
[names...]`` prints a Markdown table."""

from __future__ import annotations

import re
import sys
from collections import Counter


def summarize(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = Counter(re.findall(r"FileScan parquet .*?file:[^\]]*/([a-z_]+)\.parquet", plan))
    pushed = sum(1 for f in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if f)
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                               r"CartesianProduct)", plan))
    return {
        "scans": dict(scans),
        "scans_with_pushed_filters": pushed,
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange SinglePartition|\bExchange RoundRobin", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "joins": dict(joins),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python_udf": bool(re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython", plan)),
    }


def main(argv):
    from innspark.plans.registry import Mart
    from innspark.session import get_spark
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    names = argv[1:]
    spark = get_spark()
    print("| query | scans (table x n) | shuffles (single-partition) | joins | windows |")
    print("|---|---|---|---|---|")
    for n in names:
        s = summarize(Mart(spark, sf_dir)[n])
        scans = ", ".join(f"{t}x{c}" for t, c in sorted(s["scans"].items()))
        joins = ", ".join(f"{j.replace('Join', '')} {c}" for j, c in sorted(s["joins"].items()))
        print(f"| {n} | {scans} | {s['shuffles']} ({s['single_partition']}) | {joins} | {s['windows']} |")


if __name__ == "__main__":
    main(sys.argv[1:])
