"""Print the shape of each registered query's final (adaptive) physical plan as
a markdown table: shuffles, broadcasts, join strategies, partial top-1s,
aggregations and whole-stage-codegen stages.

    python tools/plan_summary.py [sf_dir] [query,query,...]
"""

from __future__ import annotations

import importlib.util
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

COLUMNS = [
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range/single", r"Exchange (?:rangepartitioning|SinglePartition)"),
    ("broadcasts", r"BroadcastExchange"),
    ("reused", r"Reused"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("partial top-1", r"WindowGroupLimit.*Partial"),
    ("hash aggs", r"HashAggregate"),
    ("sort aggs", r"SortAggregate"),
    ("codegen stages", r"^\s*[:+\- ]*\*\(\d+\)|WholeStageCodegen"),
]


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()      # runs the adaptive plan to its final form
    text = qe.executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    from ordersmith.session import get_session

    spark = get_session("local[8]", app="plan-summary", shuffle_partitions=8)
    spec = importlib.util.spec_from_file_location("e", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    print("| query | " + " | ".join(c for c, _ in COLUMNS) + " |")
    print("| --- |" + " --- |" * len(COLUMNS))
    for name, fn in mod.queries().items():
        if only and name not in only:
            continue
        plan = final_plan(fn(spark, sf_dir))
        counts = [len(re.findall(p, plan, flags=re.M)) for _, p in COLUMNS]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
