"""Write PLANS.md: the physical-plan shape of every registered batch query.

Usage: python -m tests.plan_report [sf_dir]   (default /root/testdata/sf0.01)

For each query the executed (adaptive, final) plan is summarised: input
scans, shuffles, join strategies, partial top-k limits and whole-stage
codegen stages. Streaming twins are listed separately (their plan is a
stateful micro-batch plan; the registered query returns the sink table).
"""

from __future__ import annotations

import re
import sys


def summarise(plan: str) -> dict:
    final = plan.split("+- == Initial Plan ==")[0]
    return {
        "scans": len(re.findall(r"FileScan|(?<!File)Scan parquet", final)),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", final)),
        "reused": final.count("ReusedExchange"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "partial_topk": final.count("WindowGroupLimit") // 2,
        "codegen": len(re.findall(r"\*\(\d+\)", final)),
        "python": int(any(s in final for s in ("BatchEvalPython", "ArrowEvalPython", "InPandas"))),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    from flowscope.session import build_session
    from flowscope.plans.catalog import QUERIES
    spark = build_session("local[8]", 8)
    rows = []
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        rows.append((name, summarise(df._jdf.queryExecution().executedPlan().toString())))
    cols = ["scans", "shuffles", "reused", "bhj", "smj", "partial_topk", "codegen", "python"]
    out = ["# PLANS — physical plan shape of every registered batch query", "",
           f"Generated by `python -m tests.plan_report {sf_dir}` (final adaptive plans, local[8]).",
           "Columns: parquet scans in the returned plan (staged tables count as scans; the raw",
           "input of a staged query was scanned once when it was written), shuffle exchanges,",
           "reused exchanges, broadcast-hash and sort-merge joins, partial WindowGroupLimit",
           "(top-k cut before the shuffle), whole-stage-codegen stages, Python evaluation (must be 0).",
           "", "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    out += [f"| `{n}` | " + " | ".join(str(s[c]) for c in cols) + " |" for n, s in rows]
    out += ["", "Streaming twins (`stream_*`) run a watermarked stateful aggregation per micro-batch",
            "(append mode; update/complete for the running total and the global top-k) and",
            "`foreachBatch` applies the batch functions above; each returns its sink as a table."]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
