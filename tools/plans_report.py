"""Write PLANS.md: the final (post-AQE) physical plan of every registered query.

Usage: python tools/plans_report.py [sf_dir] [out]
Each query runs first, into the noop sink through its own query execution,
so the adaptive plan shown is the one that actually ran (runtime broadcast
conversions, coalescing). Nothing is collected.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerostat.session import build_session  # noqa: E402
from aerostat.catalog import QUERIES  # noqa: E402


def compact(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/([^/\]]+)\]", r"Location: \1", plan)
    plan = re.sub(r"file:/[^\s,\]]*/(aerostat/[^\s,\]]*)", r"<shared>/\1", plan)
    return plan


def ran(df) -> str:
    """The final plan of ``df``, run row by row without collecting it."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=16)
    parts = [f"# Physical plans\n\nFinal adaptive plans of every registered query on `{os.path.basename(sf)}` "
             "(`local[8]`, 16 shuffle partitions, AQE on), generated by `tools/plans_report.py`.\n"]
    for name, q in QUERIES.items():
        df = q(spark, sf)
        plan = compact(ran(df))
        parts.append(f"## {name}\n\n```\n{plan.rstrip()}\n```\n")
    with open(out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
