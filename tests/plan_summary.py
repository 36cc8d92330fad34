"""Summarise the physical plan of every registered query into PLANS.md.

    python tests/plan_summary.py [sf_dir]

Per query: shuffles (Exchange hashpartitioning / SinglePartition / range), broadcasts, partial
aggregates, partial WindowGroupLimits (top-k cut before the shuffle), nested-loop joins, and the
columns and filters the parquet scans push down. Streaming queries are listed without a plan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    scans = [ln for ln in lines if "FileScan parquet" in ln]
    pushed = sum(1 for s in scans if re.search(r"PushedFilters: \[[^\]]", s))
    cols = []
    for s in scans:
        m = re.search(r"FileScan parquet \[([^\]]*)\]", s)
        if m:
            cols.append(len(m.group(1).split(",")))
    return {
        "shuffles": sum(1 for ln in lines if re.search(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", ln)),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "partial_agg": sum(1 for ln in lines if "partial_" in ln and "Aggregate" in ln),
        "wgl_partial": sum(1 for ln in lines if "WindowGroupLimit" in ln and "Partial" in ln),
        "nl_joins": sum(1 for ln in lines if "BroadcastNestedLoopJoin" in ln),
        "scans": len(scans),
        "scan_cols": "/".join(str(c) for c in cols),
        "pushed_filter_scans": pushed,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from trendlens.session import local_session
    from trendlens.streaming import registered
    spark = local_session(8)
    rows = []
    for name, fn in sorted(entry.queries().items()):
        if name in registered.QUERIES:
            rows.append((name, None))
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarise(plan)))
    keys = ["shuffles", "broadcasts", "partial_agg", "wgl_partial", "nl_joins", "scans", "scan_cols", "pushed_filter_scans"]
    out = ["# Physical plan summary", "",
           f"Generated by `tests/plan_summary.py` at {os.path.basename(sf_dir)} (initial AQE plans; stage tables are",
           "the materialised inputs each query reads). `scan_cols` = columns read per parquet scan.", "",
           "| query | " + " | ".join(keys) + " |", "|" + " --- |" * (len(keys) + 1)]
    for name, s in rows:
        if s is None:
            out.append(f"| {name} | " + " | ".join(["stream"] + [""] * (len(keys) - 1)) + " |")
        else:
            out.append(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
