"""Command line for the jobs.

    python -m branchcost full-load      --employees E --timesheets T --result R
    python -m branchcost salary-period  --employees E --timesheets T --result R
    python -m branchcost incremental    --employees E --timesheets T --result R \\
                                        --staging-employees SE --staging-timesheets ST [--state S] [--current-employees C]
    python -m branchcost from-state     --employees E --state S --result R
    python -m branchcost current-period --employees E --timesheets T --result R [--year Y --month M]

Inputs ending in `.csv` (or a folder given with --format csv) are read as
CSV with a header row, `table:name` as a catalog table, anything else as
Parquet; results and staging may be `table:name` as well. --year and --month
default to the current ones, each alone. The session comes from
`SparkSession.builder.getOrCreate()`, so spark-submit settings apply.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from branchcost.plans import jobs
from branchcost.schemas import EMPLOYEES, TIMESHEETS
from branchcost.session import apply_engine_conf, ensure_checkpoint_dir
from branchcost.sources import read_employees_csv, read_timesheets_csv, table_name


def _read(spark: SparkSession, path: str, fmt: str | None, kind: str) -> DataFrame:
    schema = EMPLOYEES if kind == "employees" else TIMESHEETS
    if table_name(path):
        return spark.table(table_name(path)).select(*schema.fieldNames())
    is_csv = fmt == "csv" or (fmt is None and path.lower().endswith(".csv"))
    if is_csv:
        return read_employees_csv(spark, path) if kind == "employees" else read_timesheets_csv(spark, path)
    return spark.read.schema(schema).parquet(path)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="branchcost", description=__doc__.split("\n")[0])
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("full-load", "salary-period", "incremental", "from-state", "current-period"):
        p = sub.add_parser(name)
        p.add_argument("--employees", required=True)
        if name != "from-state":
            p.add_argument("--timesheets", required=True)
        p.add_argument("--result", required=True)
        p.add_argument("--format", choices=["csv", "parquet"], default=None)
        if name == "incremental":
            p.add_argument("--staging-employees", required=True)
            p.add_argument("--staging-timesheets", required=True)
            p.add_argument("--current-employees")
        if name in ("incremental", "from-state"):
            p.add_argument("--state", required=name == "from-state")
        if name == "current-period":
            p.add_argument("--year", type=int)
            p.add_argument("--month", type=int)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"branchcost-{args.job}").getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    emp = _read(spark, args.employees, args.format, "employees")
    if args.job == "from-state":
        jobs.run_full_from_state(spark, emp, args.state, args.result)
        return 0
    ts = _read(spark, args.timesheets, args.format, "timesheets")
    if args.job == "full-load":
        status = jobs.run_full_load(emp, ts, args.result)
    elif args.job == "salary-period":
        status = jobs.run_salary_period(emp, ts, args.result)
    elif args.job == "incremental":
        status = jobs.run_incremental(
            spark, emp, ts, args.staging_employees, args.staging_timesheets, args.result, args.state, args.current_employees
        )
    else:
        status = jobs.run_current_period(emp, ts, args.result, args.year, args.month)
    if not status.wrote:
        print(status.message)
    return 0


if __name__ == "__main__":
    sys.exit(main())
