"""Write PLANS.md: physical-plan facts of every registered batch query.

Usage: python tools/plan_summary.py [sf_dir]   (default sf0.01)
Collects each query through its own plan (so AQE settles that plan, and the
part before the initial one is the final one) and records Parquet scans, shuffles, join strategies, partial top-k and the
filters pushed to Parquet.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.config import local_session  # noqa: E402
from shoplens.plans import registry  # noqa: E402

STREAM = ("stream_", "report_ad_", "report_province", "report_click", "ad_log_source")


def facts(plan: str) -> dict:
    joins = sorted({j for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
                                "CartesianProduct") if j in plan})
    pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if m and m != "IsNotNull(ts)"})
    return {
        "scans": plan.count("FileScan parquet"),
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                                   plan)),
        "joins": ", ".join(joins) or "-",
        "partial top-k": "yes" if "WindowGroupLimit" in plan or "TakeOrderedAndProject" in plan else "-",
        "python": "yes" if re.search(r"EvalPython|InPandas|MapInArrow", plan) else "no",
        "pushed": "; ".join(p[:60] for p in pushed[:2]) or "-",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    rows = []
    for name, fn in sorted(registry.queries().items()):
        if name.startswith(STREAM):
            continue
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, facts(plan.split("== Initial Plan ==")[0])))
    cols = ["scans", "shuffles", "joins", "partial top-k", "python", "pushed"]
    out = ["# PLANS", "",
           f"Final (AQE) physical plans of the registered batch queries on `{sf}`, local[8], 8 shuffle",
           "partitions; generated by `tools/plan_summary.py`. Stream queries read the state logs and are",
           "covered by `tests/test_stream.py`. `scans` counts Parquet scans in the final plan (0 when the",
           "query reads a checkpointed intermediate); `shuffles` counts hash, range and single-partition",
           "exchanges.", "",
           "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for name, f in rows:
        out.append(f"| {name} | " + " | ".join(str(f[c]).replace("|", "/") for c in cols) + " |")
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out) + "\n")
    print(f"{len(rows)} plans")


if __name__ == "__main__":
    main()
