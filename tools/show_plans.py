"""Print the formatted physical plans of the headline queries (docs/PLANS.md).

    python tools/show_plans.py [--sf /root/testdata/sf0.01] > docs/PLANS.md
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["validate_trips", "rejected_trips", "enrich_trips", "daily_borough", "daily_zone", "daily_service",
            "rejects_by_rule", "column_profile", "compression_report", "top_routes", "raw_scan_month",
            "current_month_trips"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    from tripspark.plans import inspect, registry
    from tripspark.session import build_session

    spark = build_session()
    qs = registry.queries()
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `python tools/show_plans.py` on `{os.path.basename(args.sf)}` (local mode, AQE "
          "initial plans). Read `PushedFilters` / `PartitionFilters` / `ReadSchema` on each scan, the join "
          "strategy, and the partial/final aggregate pairs around each `Exchange`.\n")
    for name in HEADLINE:
        df = qs[name](spark, args.sf)
        text = inspect.plan_text(df, "formatted")
        print(f"## {name}\n")
        print("joins: " + (", ".join(inspect.join_strategies(df)) or "none")
              + "; aggregates: " + (", ".join(inspect.aggregate_strategies(df)) or "none")
              + f"; python UDF: {inspect.has_python_udf(df)}\n")
        print("```")
        print(text.split("\n\n(1)")[0].strip())
        for line in text.splitlines():
            if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema")):
                print(line[:400])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
