"""Time every registered query at one scale factor.

Runs each ``queries()`` key on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up, then the
median of ``$BENCH_REPS`` (default 3) timed runs.  A run builds the plan
(including any eager sampling / materialisation it needs) and executes it
completely into Spark's ``noop`` sink, so no result is collected to the
driver.  Prints ONE JSON line; ``value`` is the sum of the per-query
medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cohortlens import build_session
    from cohortlens.session import drop_stable_tables
    from cohortlens.plans import queries

    spark = build_session(cpus=cpus)
    qs = queries()
    names = only or sorted(qs)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    per_query = {}
    for name in names:
        run(name)  # warm-up
        per_query[name] = round(statistics.median(run(name) for _ in range(reps)), 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
        "reps": reps,
    }))
    drop_stable_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
