"""Summarise the physical plans of the data-modelling queries into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] [out.md]

For each query: number of shuffles (hash / range / single-partition
exchanges), joins by kind, what is broadcast, aggregate and window
operators, WindowGroupLimit placement, and each scan's pushed filters and
read columns. Plans are the pre-execution adaptive plans (AQE may still
coalesce partitions or switch a join to broadcast from measured sizes).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    out = {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "nested_loop": plan.count("NestedLoopJoin"),
        "cartesian": plan.count("CartesianProduct"),
        "hash_agg": plan.count("HashAggregate(") - plan.count("ObjectHashAggregate("),
        "object_agg": plan.count("ObjectHashAggregate("),
        "sort_agg": plan.count("SortAggregate("),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limit_partial": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "generate": plan.count("Generate "),
        "python_udf": plan.count("BatchEvalPython") + plan.count("ArrowEvalPython"),
    }
    scans = []
    for ln in lines:
        if "FileScan parquet" in ln:
            loc = re.search(r"Location: \w+\(\d+ paths\)\[(?:file:)?([^,\]]*)", ln)
            path = loc.group(1) if loc else "?"
            name = "state table under the checkpoint folder" if "..." in path or "/strata/" in path else path.rsplit("/", 1)[-1]
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            part = re.search(r"PartitionFilters: \[([^\]]*)\]", ln)
            schema = re.search(r"ReadSchema: struct<([^>]*)", ln)
            cols = [c.split(":")[0] for c in schema.group(1).split(",")] if schema else []
            scans.append(
                {
                    "table": name,
                    "columns": len(cols),
                    "pushed": (pushed.group(1) if pushed else "")[:120],
                    "partition_filters": (part.group(1) if part else "")[:80],
                }
            )
    out["scans"] = scans
    bcast = []
    for i, ln in enumerate(lines):
        if "BroadcastExchange" in ln:
            for nxt in lines[i + 1 : i + 6]:
                m = re.search(r"\[file:[^\]]*/([^/\]]+)\]", nxt)
                if m:
                    bcast.append(m.group(1))
                    break
            else:
                bcast.append("derived")
    out["broadcast"] = bcast
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    target = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(__file__)), "PLANS.md")
    from strata.plans.queries import QUERIES
    from strata.session import get_session

    spark = get_session(app="strata-plans", shuffle_partitions=16)
    rows = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarize(plan)))
    with open(target, "w") as f:
        f.write("# Physical plans of the registered queries\n\n")
        f.write(f"Generated by `tools/plan_report.py` on `{sf_dir}` (pre-execution adaptive plans; the fold\n")
        f.write("queries show only the final read of their written table, their steps are separate jobs).\n\n")
        f.write("| query | shuffles | SMJ | BHJ | nested loop / cartesian | hash / object / sort agg | windows "
                "(partial limit) | broadcast sides | python UDF |\n|---|---|---|---|---|---|---|---|---|\n")
        for name, s in rows:
            f.write(
                f"| {name} | {s['shuffles']} | {s['smj']} | {s['bhj']} | {s['nested_loop']} / {s['cartesian']} | "
                f"{s['hash_agg']} / {s['object_agg']} / {s['sort_agg']} | {s['windows']} ({s['group_limit_partial']}) | "
                f"{', '.join(s['broadcast']) or '-'} | {s['python_udf']} |\n"
            )
        f.write("\n## Scans (table: columns read; pushed filters; partition filters)\n\n")
        for name, s in rows:
            f.write(f"**{name}**\n\n")
            for sc in s["scans"]:
                f.write(
                    f"- `{sc['table']}`: {sc['columns']} cols; pushed `[{sc['pushed']}]`"
                    + (f"; partitions `[{sc['partition_filters']}]`" if sc["partition_filters"] else "")
                    + "\n"
                )
            f.write("\n")
    print(f"wrote {target}")
    spark.stop()


if __name__ == "__main__":
    main()
