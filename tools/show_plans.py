"""Write docs/PLANS.md: physical plans of the headline queries with
scale-like settings (data tables never broadcast, AQE off so the static
plan is shown).

usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["customer_metrics", "rfm_segments", "cohort_retention", "month3_churn", "quarter_ltv",
         "monthly_revenue", "txn_with_cohort"]
KEEP = ("Exchange", "Join", "Aggregate", "Window", "Scan", "Expand", "Sort", "Generate", "Union", "Limit",
        "TakeOrdered")


def main() -> None:
    from cohortlens import build_session
    from cohortlens.plans import queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans (scale-like settings)", "",
           "Generated by `tools/show_plans.py`: `autoBroadcastJoinThreshold=-1` (no data table is",
           "broadcast, as at 100 TB), AQE off (static plan). Only the",
           "operators that move or group data are kept; long expressions are cut.", ""]
    qs = queries()
    for name in NAMES:
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf_dir).explain()
        lines = []
        for line in buf.getvalue().splitlines():
            if any(k in line for k in KEEP):
                line = re.sub(r"#\d+L?", "", line)
                line = re.sub(r"\[plan_id=\d+\]", "", line)
                lines.append(line[:160])
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"),
              "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
