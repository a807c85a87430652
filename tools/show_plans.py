"""Print the executed physical plan of registered queries (scale review aid).

usage: python tools/show_plans.py [sf_dir] key [key ...]
Only operator lines are kept (scans with pushed filters / read schema, exchanges,
joins, aggregates, windows, limits), so the shape is readable at a glance.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scoutlens.plans import QUERIES  # noqa: E402
from scoutlens.session import build_session  # noqa: E402

KEEP = ("Scan", "Exchange", "Join", "Aggregate", "Window", "TakeOrdered", "Limit", "MapInPandas",
        "InMemoryTableScan", "ExistingRDD", "Subquery", "Generate")


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    for key in args:
        df = QUERIES[key](spark, sf)
        df.write.format("noop").mode("overwrite").save()      # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {key}\n```")
        for line in plan.splitlines():
            if any(k in line for k in KEEP):
                print(line.rstrip()[:180])
        print("```\n")


if __name__ == "__main__":
    main()
