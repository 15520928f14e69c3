"""Summarise the physical plan of the engine's queries (plans/queries.py) as a Markdown table.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Columns: shuffles (Exchange nodes, reused ones counted separately), join
strategies, aggregate operators, scan columns and pushed filters.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.plans.queries import QUERIES  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")
AGGS = ("HashAggregate", "SortAggregate", "ObjectHashAggregate")


def summarise(plan: str) -> dict:
    ops = Counter(re.findall(r"\b([A-Z][A-Za-z]+)\b(?=\s*[\[(]|\s*$)", plan, flags=re.M))
    lines = plan.splitlines()
    exchanges = sum(1 for ln in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", ln))
    reused = sum(1 for ln in lines if "ReusedExchange" in ln)
    joins = Counter(j for ln in lines for j in JOINS if f"{j} " in ln or ln.strip().endswith(j))
    aggs = Counter(a for ln in lines for a in AGGS if re.search(rf"\b{a}\(", ln))
    # long schemas are cut with "..." by Spark; count the fields shown, marked "+"
    widths = sorted(
        {f"{len(m.split(','))}{'+' if cut == '...' else ''}" for m, cut in re.findall(r"ReadSchema: struct<([^>\n]*?)(>|\.\.\.)", plan)}
    )
    pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]\n]*)\]", plan) if m})
    return {"exchanges": exchanges, "reused": reused, "joins": dict(joins), "aggs": dict(aggs), "widths": widths,
            "pushed": pushed, "ops": ops}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans of the registered queries ({Path(sf_dir).name}, before AQE re-planning)\n")
    print("Generated by `python tools/plan_report.py`. Shuffles = Exchange nodes (reused exchanges in brackets);")
    print("scan columns = fields in each ReadSchema ('+': Spark cut the list short).\n")
    print("Queries that decide rows write the checked rows first: their plan begins at that table, and `events` is scanned once.\n")
    print("| query | shuffles | joins | aggregates | scan columns | pushed filters |")
    print("|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        joins = ", ".join(f"{k}×{v}" for k, v in s["joins"].items()) or "-"
        aggs = ", ".join(f"{k}×{v}" for k, v in s["aggs"].items()) or "-"
        pushed = "; ".join(p[:60] for p in s["pushed"]) or "-"
        print(f"| {name} | {s['exchanges']} ({s['reused']}) | {joins} | {aggs} | {s['widths']} | {pushed} |")


if __name__ == "__main__":
    main()
