"""Print a markdown table summarising the physical plan of every query.

    python scripts/plan_summary.py [sf_dir]

Per query: number of shuffle exchanges, join strategies, whether the
aggregation is split into partial + final, and the top-k operators used.
The plan is the one Spark picks before running (adaptive execution may
still change join strategies at run time).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparktally.plans import QUERIES  # noqa: E402
from sparktally.session import get_session  # noqa: E402


def summarise(plan: str) -> dict[str, str]:
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi)", plan)))
    return {
        "exchanges": str(len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan))),
        "joins": ", ".join(f"{j} {t}" for j, t in joins) or "-",
        "partial agg": "yes" if "partial_" in plan else "-",
        "top-k": ", ".join(x for x in ("WindowGroupLimit", "TakeOrderedAndProject") if x in plan) or "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16, extra_conf={"spark.ui.showConsoleProgress": "false"})
    cols = ["exchanges", "joins", "partial agg", "top-k"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- " * (len(cols) + 1) + "|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | " + " | ".join(s[c] for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
