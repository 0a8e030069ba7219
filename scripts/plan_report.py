"""Summarise the physical plan of every registered batch query.

For each query: shuffles (Exchange; "full" are those of ordered scans that move rows by
keys and chunk, not summaries), broadcasts, sort-merge / hash joins,
nested-loop joins, window operators, partial top-N (WindowGroupLimit),
Python stages, and the columns read from parquet.  Writes a markdown table.

Usage: python scripts/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "nlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow \[",
    "partial_topn": r"WindowGroupLimit .*Partial",
    "python": r"MapInPandas|MapInArrow|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython",
    "single_partition": r"Exchange SinglePartition",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else None
    from eventide.session import build_session
    spark = build_session(shuffle_partitions=8)
    for kv in filter(None, os.environ.get("EXTRA_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    from eventide.plans import QUERIES
    rows = []
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "jdbc_")):
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = {k: len(re.findall(v, plan)) for k, v in COUNTS.items()}
        lines = plan.split("\n")
        c["full"] = sum("_chunk#" in a and "Exchange hash" in a and "Aggregate" not in b for a, b in zip(lines, lines[1:]))
        schemas = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
        rows.append((name, c, "; ".join(schemas)))
    lines = ["| query | shuffles | of these full, by (keys, chunk) | broadcasts | SMJ | BHJ | NLJ | windows | partial top-N | python | "
             "single-partition | parquet columns read |",
             "|---|---|---|---|---|---|---|---|---|---|---|---|"]
    for name, c, schemas in rows:
        lines.append(f"| {name} | {c['shuffles']} | {c['full']} | {c['broadcasts']} | {c['smj']} | {c['bhj']} | "
                     f"{c['nlj']} | {c['windows']} | {c['partial_topn']} | {c['python']} | "
                     f"{c['single_partition']} | {schemas} |")
    text = "\n".join(lines)
    if out:
        with open(out, "w") as f:
            f.write(text + "\n")
    print(text)
    spark.stop()


if __name__ == "__main__":
    main()
