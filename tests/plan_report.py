"""Write PLANS.md: the physical shape of the headline queries in "scale
mode" — static broadcast joins off (as for sides too large to broadcast) and
AQE off (so the static plan is shown) — counting the shuffles and listing the
scans with their pushed filters and read schemas.

usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HEADLINE = [
    "orders_full", "monthly_revenue", "revenue_by_state_mart", "weather_impact", "kpi_summary_rate",
    "state_revenue_share", "scatter_sample", "table_profile", "dq_unique", "filter_year_in",
]


def _scans(plan: str):
    out = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        m = re.search(r"/([\w.-]+\.parquet)", line)
        name = m.group(1) if m else ("orders_full (stored table)" if "mercato-" in line else "?")
        part = re.search(r"PartitionFilters: (\[[^\]]*\])", line)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (\S+)", line)
        out.append((name, part.group(1) if part else "[]", pushed.group(1) if pushed else "[]",
                    schema.group(1) if schema else ""))
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as E
    from mercato.plans.session import build_session

    spark = build_session(
        master="local[8]", shuffle_partitions=8,
        extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"},
    )
    qs = E.queries()
    print("# Physical plans at scale\n")
    print("Generated by `tests/plan_report.py`. Static broadcast joins are disabled and AQE is off,")
    print("so the plans show what Spark does when no side is small enough to broadcast; nothing is")
    print("hinted. On the cluster AQE additionally coalesces partitions, splits skewed join")
    print("partitions and converts joins whose measured side is small, the weather's among them.")
    print("`tests/hot_key_tasks/` shows a hot key of the customers join, plain and spread.\n")
    print("\"shuffles\" counts every exchange, including those of pre-aggregated sides. In")
    print("`orders_full`, for example, the large orders side is shuffled twice (by order key, which")
    print("the payments/items joins then reuse, and by customer_id); the other exchanges carry")
    print("per-order aggregates of lineitem and the customers table.\n")
    for name in HEADLINE:
        df = qs[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)
        joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(LeftOuter|Inner|LeftSemi|LeftAnti|FullOuter)?,", plan)
        scans = _scans(plan)
        aggs = plan.count("HashAggregate(keys=")
        partial = len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan))
        print(f"## {name}\n")
        print(f"- shuffles: {len(exchanges)} — " + (", ".join(sorted(set(e.split('(')[0] + ('(' + e.split('(')[1].split(',')[0].split('#')[0] + ')' if '(' in e else '') for e in exchanges))) or "none"))
        print(f"- joins: " + (", ".join(j[0] for j in joins) or "none"))
        print(f"- hash aggregates: {aggs} ({partial} partial, map-side)")
        print("- scans:")
        for name_, part, pushed, schema in scans:
            print(f"  - `{name_}` partition filters {part}, pushed {pushed}, reads `{schema[:150]}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
