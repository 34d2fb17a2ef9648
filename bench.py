"""Benchmark the headline queries.

Runs each query of HEADLINE over the tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS], executing the whole plan
into a no-op sink (nothing is collected to the driver), and prints one
JSON line: {"metric", "value", "unit", "queries", "sf"}. After one
warm-up pass over all headline queries (JIT, codegen caches), each query
is timed $BENCH_REPEAT times (default 3), plan building included; `value`
is the sum of the per-query best times.

`jobs` times three jobs without the seeding of their tables, which the keys
`branch_salary_upsert` and `branch_salary_period_replace` include: a full
load, an incremental load whose delta is the last month, and a reload of that
month.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from branchcost.plans import jobs  # noqa: E402
from branchcost.plans.catalog import QUERIES  # noqa: E402
from branchcost.session import build_session, scratch_path  # noqa: E402
from branchcost.sinks.staging import EMPTY_MARK, append_batch  # noqa: E402
from branchcost.sinks.writers import reload_months  # noqa: E402
from branchcost.sources import load_employees, load_timesheets  # noqa: E402

HEADLINE = [
    "branch_salary_full",
    "branch_salary_union_literal",
    "salary_period",
    "period_employee_range_join",
    "period_employee_exploded",
    "timesheet_employee",
    "timesheets_delta",
    "branch_salary_upsert",
    "branch_salary_period_replace",
]


def job_timings(spark, sf_dir: str, repeat: int) -> dict[str, float]:
    emp, ts = load_employees(spark, sf_dir), load_timesheets(spark, sf_dir)
    last = ts.agg(F.max("date")).first()[0]  # its month is the delta
    staged = ts.filter(F.col("date") <= f"{last[:8]}01")
    best: dict[str, list[float]] = {}
    for _ in range(repeat + 1):  # the first round warms up
        paths = [scratch_path(spark, name) for name in ("result", "employees", "timesheets")]
        runs = {
            "full_load": lambda: jobs.run_full_load(emp, ts, paths[0]),
            "incremental_last_month": lambda: jobs.run_incremental(spark, emp, ts, paths[1], paths[2], paths[0]),
            "current_period_last_month": lambda: jobs.run_current_period(
                emp, ts, paths[0], int(last[:4]), int(last[5:7])
            ),
        }
        append_batch(emp, paths[1], EMPTY_MARK)
        reload_months(staged, paths[2], materialize=False)
        for name, run in runs.items():
            t0 = time.perf_counter()
            run()
            best.setdefault(name, []).append(time.perf_counter() - t0)
    return {name: round(min(times[1:]), 3) for name, times in best.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="branchcost-bench")

    for name in HEADLINE:  # warm-up pass
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_wall",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "jobs": job_timings(spark, sf_dir, repeat),
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
