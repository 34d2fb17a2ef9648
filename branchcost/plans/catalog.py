"""Registered queries: one per operator or job, over the bound test tables.

Every query reads `supplier` and `lineitem` of a scale-factor folder
through the bindings, whole. Fixed parameters of the incremental keys:
the staged timesheets are those dated on or before TIMESHEET_CUT, the
staged employees those joining on or before EMPLOYEE_CUT, and the
current-period job runs for PERIOD.

Keys whose operator is a sink or a job write to a fresh folder under the
session's checkpoint directory and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchcost.operators import (
    branch_salary,
    branch_salary_month,
    branch_salary_self_join,
    dedup_employees,
    duplicate_ids,
    employees_after,
    employees_delta,
    employees_period_ready,
    high_water_marks,
    lookup_existing,
    period_employee_exploded,
    period_employee_range_join,
    period_list,
    salary_base_distinct,
    timesheet_bad,
    timesheet_cleansing,
    timesheet_employee,
    timesheet_good,
    timesheet_hours,
    timesheets_delta,
    timesheets_in_period,
    work_hour_by_branch_month,
)
from branchcost.plans.jobs import full_from_state, full_load, run_current_period, run_incremental, salary_by_period
from branchcost.schemas import BRANCH_SALARY, EMPLOYEE_COLUMNS, EMPLOYEES, STAGED_TIMESHEETS, TIMESHEET_COLUMNS, TIMESHEETS
from branchcost.session import scratch_path
from branchcost.sinks.current import current_employees, keep_current
from branchcost.sinks.staging import EMPTY_MARK, append_batch, read_staged, staged_mark, staged_period_list
from branchcost.sinks.writers import reload_months, write_partitioned_overwrite
from branchcost.sources import (
    load_employees,
    load_timesheets,
    read_employees_csv,
    read_partitioned,
    read_timesheets_csv,
)

# Fixed parameters of the incremental keys.
TIMESHEET_CUT = "1999-06-17"
EMPLOYEE_CUT = "1997-06-17"
PERIOD = (1999, 6)
PLANTED_ROW = (-1, 1999, 6, 1.0, 1, 1.0)  # existing result row of a branch absent from the delta

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return load_employees(spark, sf_dir), load_timesheets(spark, sf_dir)


def staged_timesheets(ts: DataFrame) -> DataFrame:
    return ts.filter(F.col("date") <= F.lit(TIMESHEET_CUT))


def staged_employees(emp: DataFrame) -> DataFrame:
    return emp.filter(F.col("join_date") <= F.lit(EMPLOYEE_CUT))


def existing_result(spark: SparkSession, emp: DataFrame, ts: DataFrame) -> DataFrame:
    """Result table as a full load over the staged rows left it, plus a planted row."""
    planted = spark.createDataFrame([PLANTED_ROW], BRANCH_SALARY)
    return full_load(staged_employees(emp), staged_timesheets(ts)).unionByName(planted)


def delta_result(emp: DataFrame, ts: DataFrame) -> DataFrame:
    """branch_salary of the timesheet delta against the staged employees after their increment."""
    staged_emp = staged_employees(emp)
    employees = staged_emp.unionByName(employees_delta(emp, staged_emp))
    delta_ts = timesheets_delta(ts, staged_timesheets(ts))
    return branch_salary(timesheet_hours(delta_ts), dedup_employees(employees))


# ---- full load and its stages -------------------------------------------------


def q_branch_salary_full(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return full_load(emp, ts)


def q_branch_salary_union_literal(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return branch_salary(timesheet_hours(ts, both_blank_twice=True), dedup_employees(emp))


def q_branch_salary_self_join(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return branch_salary_self_join(timesheet_hours(ts), dedup_employees(emp))


def q_timesheet_cleansing(spark, sf_dir):
    return timesheet_cleansing(load_timesheets(spark, sf_dir))


def q_timesheet_bad(spark, sf_dir):
    return timesheet_bad(timesheet_cleansing(load_timesheets(spark, sf_dir)))


def q_timesheet_good(spark, sf_dir):
    return timesheet_good(timesheet_cleansing(load_timesheets(spark, sf_dir)))


def q_timesheet_work_hours(spark, sf_dir):
    return timesheet_hours(load_timesheets(spark, sf_dir))


def q_employees_dedup(spark, sf_dir):
    return dedup_employees(load_employees(spark, sf_dir))


def q_employees_duplicate_ids(spark, sf_dir):
    return duplicate_ids(load_employees(spark, sf_dir))


def q_employees_period_ready(spark, sf_dir):
    return employees_period_ready(load_employees(spark, sf_dir))


def q_timesheet_employee(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return timesheet_employee(timesheet_hours(ts), dedup_employees(emp))


def q_work_hour_by_branch_month(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return work_hour_by_branch_month(timesheet_hours(ts), dedup_employees(emp))


def q_salary_base_distinct(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return salary_base_distinct(timesheet_hours(ts), dedup_employees(emp))


def q_branch_salary_month(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return branch_salary_month(timesheet_hours(ts), dedup_employees(emp))


# ---- salary per employment period ---------------------------------------------


def q_period_list(spark, sf_dir):
    return period_list(load_timesheets(spark, sf_dir), ordered=True)


def q_period_employee_range_join(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return period_employee_range_join(period_list(ts), employees_period_ready(emp))


def q_period_employee_exploded(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return period_employee_exploded(period_list(ts), employees_period_ready(emp))


def q_salary_period(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return salary_by_period(emp, ts)


# ---- incremental building blocks ----------------------------------------------


def q_high_water_marks(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return high_water_marks(
        {
            "employees": (staged_employees(emp), "join_date"),
            "timesheets": (staged_timesheets(ts), "date"),
            # staging before the first run: nothing dated before 1900
            "timesheets_empty": (ts.filter(F.col("date") < F.lit("1900-01-01")), "date"),
        }
    )


def q_high_water_marks_staged(spark, sf_dir):
    """The marks as a job finds them: committed ones, and the last month's partition of a table without one."""
    emp, ts = _inputs(spark, sf_dir)
    paths = {name: scratch_path(spark, name) for name in ("employees", "timesheets", "timesheets_empty")}
    append_batch(staged_employees(emp), paths["employees"], EMPTY_MARK)
    reload_months(staged_timesheets(ts), paths["timesheets"], materialize=False)
    kinds = {"employees": (EMPLOYEES, "join_date"), "timesheets": (STAGED_TIMESHEETS, "date"), "timesheets_empty": (STAGED_TIMESHEETS, "date")}
    rows = [(name, staged_mark(spark, paths[name], *kinds[name])) for name in paths]
    return spark.createDataFrame(rows, "table_name string, max_date date")


def q_period_list_staged(spark, sf_dir):
    """The period list of the staged timesheets, from their partitions."""
    path = scratch_path(spark, "staging-timesheets")
    reload_months(load_timesheets(spark, sf_dir), path, materialize=False)
    return staged_period_list(spark, path)


def q_employees_delta(spark, sf_dir):
    emp = load_employees(spark, sf_dir)
    return employees_delta(emp, staged_employees(emp))


def q_timesheets_delta(spark, sf_dir):
    ts = load_timesheets(spark, sf_dir)
    return timesheets_delta(ts, staged_timesheets(ts))


def q_timesheets_current_period(spark, sf_dir):
    return timesheets_in_period(load_timesheets(spark, sf_dir), *PERIOD)


def q_branch_salary_lookup(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    return lookup_existing(existing_result(spark, emp, ts), delta_result(emp, ts))


# ---- jobs writing tables --------------------------------------------------------


def _seed_result(spark, emp, ts) -> str:
    path = scratch_path(spark, "result")
    write_partitioned_overwrite(existing_result(spark, emp, ts), path)
    return path


def q_branch_salary_upsert(spark, sf_dir):
    """Incremental job over staged tables; the planted row survives the upsert."""
    emp, ts = _inputs(spark, sf_dir)
    result = _seed_result(spark, emp, ts)
    staging_emp = scratch_path(spark, "staging-employees")
    staging_ts = scratch_path(spark, "staging-timesheets")
    append_batch(staged_employees(emp), staging_emp, EMPTY_MARK)
    reload_months(staged_timesheets(ts), staging_ts, materialize=False)
    run_incremental(spark, emp, ts, staging_emp, staging_ts, result)
    return read_partitioned(spark, result, BRANCH_SALARY)


def q_branch_salary_from_state(spark, sf_dir):
    """Two incremental loads that keep the employee-month state; all months from the state alone."""
    emp, ts = _inputs(spark, sf_dir)
    names = ("staging-employees", "staging-timesheets", "result", "state")
    paths = [scratch_path(spark, name) for name in names]
    for part in (staged_timesheets(ts), ts):
        run_incremental(spark, emp, part, *paths)
    return full_from_state(spark, paths[3], emp)


def q_employees_current(spark, sf_dir):
    """Employees staged by three loads, the current ones kept by merging each load's batch."""
    emp, _ = _inputs(spark, sf_dir)
    staging, current = (scratch_path(spark, name) for name in ("staging-employees", "current-employees"))
    for until in ("1996-06-30", EMPLOYEE_CUT, "9999-12-31"):
        joined = staged_mark(spark, staging, EMPLOYEES, "join_date")
        append_batch(employees_after(emp.filter(F.col("join_date") <= until), joined), staging, joined)
        keep_current(spark, current, staging)
    return current_employees(spark, current)


def q_branch_salary_period_replace(spark, sf_dir):
    """Current-period job for PERIOD; the planted row of that month is removed."""
    emp, ts = _inputs(spark, sf_dir)
    result = _seed_result(spark, emp, ts)
    run_current_period(emp, ts, result, *PERIOD)
    return read_partitioned(spark, result, BRANCH_SALARY)


def q_employees_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "employees-csv")
    load_employees(spark, sf_dir).write.option("header", True).csv(path)
    return read_employees_csv(spark, path)


def q_timesheets_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "timesheets-csv")
    load_timesheets(spark, sf_dir).write.option("header", True).csv(path)
    return read_timesheets_csv(spark, path)


def q_sink_full_overwrite(spark, sf_dir):
    emp, ts = _inputs(spark, sf_dir)
    path = scratch_path(spark, "full")
    write_partitioned_overwrite(full_load(emp, ts), path)
    write_partitioned_overwrite(full_load(emp, ts), path)
    return read_partitioned(spark, path, BRANCH_SALARY)


def q_sink_staging_append(spark, sf_dir):
    emp = load_employees(spark, sf_dir)
    path = scratch_path(spark, "staging-employees")
    append_batch(staged_employees(emp), path, EMPTY_MARK)
    mark = staged_mark(spark, path, EMPLOYEES, "join_date")
    append_batch(employees_after(emp, mark), path, mark)
    return read_staged(spark, path, EMPLOYEES).select(*EMPLOYEE_COLUMNS)


def q_sink_staging_month_reload(spark, sf_dir):
    ts = load_timesheets(spark, sf_dir)
    path = scratch_path(spark, "staging-timesheets")
    reload_months(staged_timesheets(ts), path, materialize=False)
    staged = read_partitioned(spark, path, TIMESHEETS)
    reload_months(timesheets_delta(ts, staged), path)
    return read_partitioned(spark, path, TIMESHEETS).select(*TIMESHEET_COLUMNS)


QUERIES: dict[str, Query] = {
    "branch_salary_full": q_branch_salary_full,
    "branch_salary_union_literal": q_branch_salary_union_literal,
    "branch_salary_self_join": q_branch_salary_self_join,
    "timesheet_cleansing": q_timesheet_cleansing,
    "timesheet_bad": q_timesheet_bad,
    "timesheet_good": q_timesheet_good,
    "timesheet_work_hours": q_timesheet_work_hours,
    "employees_dedup": q_employees_dedup,
    "employees_duplicate_ids": q_employees_duplicate_ids,
    "employees_period_ready": q_employees_period_ready,
    "timesheet_employee": q_timesheet_employee,
    "work_hour_by_branch_month": q_work_hour_by_branch_month,
    "salary_base_distinct": q_salary_base_distinct,
    "branch_salary_month": q_branch_salary_month,
    "period_list": q_period_list,
    "period_employee_range_join": q_period_employee_range_join,
    "period_employee_exploded": q_period_employee_exploded,
    "salary_period": q_salary_period,
    "high_water_marks": q_high_water_marks,
    "high_water_marks_staged": q_high_water_marks_staged,
    "period_list_staged": q_period_list_staged,
    "employees_delta": q_employees_delta,
    "timesheets_delta": q_timesheets_delta,
    "timesheets_current_period": q_timesheets_current_period,
    "branch_salary_lookup": q_branch_salary_lookup,
    "branch_salary_upsert": q_branch_salary_upsert,
    "branch_salary_from_state": q_branch_salary_from_state,
    "employees_current": q_employees_current,
    "branch_salary_period_replace": q_branch_salary_period_replace,
    "employees_csv_scan": q_employees_csv_scan,
    "timesheets_csv_scan": q_timesheets_csv_scan,
    "sink_full_overwrite": q_sink_full_overwrite,
    "sink_staging_append": q_sink_staging_append,
    "sink_staging_month_reload": q_sink_staging_month_reload,
}
