"""Print the physical plan skeleton of headline queries (operators, exchanges, scans, pushed filters).

Usage: python tools/plans.py [sf_dir] [key ...]  -> markdown on stdout
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from trolley import catalog  # noqa: E402
from trolley.session import local_session  # noqa: E402

DEFAULT = ("department_counts", "basket_by_dow", "reorder_rate_extremes", "top_products_in_top_departments",
           "product_pairs", "dim_user_segmented", "customer_reorder_stats", "dq_unique", "iqr_outliers")
KEEP = re.compile(r"Scan|Exchange|Broadcast|Join|Aggregate|Window|TakeOrdered|Sort|Union|Expand|Generate")


def skeleton(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [ln for ln in plan.splitlines() if KEEP.search(ln)]
    out = []
    for ln in lines:
        ln = re.sub(r"#\d+L?", "", ln)
        ln = re.sub(r"\[plan_id=\d+\]", "", ln)
        ln = re.sub(r"Location: InMemoryFileIndex\([^)]*\)", "", ln)
        ln = re.sub(r", Format: Parquet", "", ln)
        ln = re.sub(r"file:[^,\]]*", "<work>", ln)
        out.append(ln[:220])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or DEFAULT
    spark = local_session(8, 16)
    reg = catalog.registry()
    for k in keys:
        df = reg[k](spark, sf)
        print(f"### {k}\n\n```\n{skeleton(df)}\n```\n")


if __name__ == "__main__":
    main()
