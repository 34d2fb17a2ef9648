"""The four jobs: full load, salary per employment period, incremental load
by high-water mark, and reload of the current month.

Each job builds one DataFrame plan from the operators and ends in one
write. Inputs are DataFrames (read from CSV, Parquet or a catalog by the
caller); staging and result tables are paths, or catalog names written
`table:name`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from branchcost.operators import (
    branch_salary,
    branch_salary_of_months,
    current_period,
    dedup_employees,
    employee_month_seconds,
    employees_after,
    employees_period_ready,
    period_list,
    salary_period,
    timesheet_hours,
    timesheets_from,
    timesheets_in_period,
)
from branchcost.schemas import EMPLOYEE_MONTH, EMPLOYEES, STAGED_TIMESHEETS, TIMESHEETS
from branchcost.session import snapshot
from branchcost.sinks.current import current_employees, keep_current
from branchcost.sinks.staging import (
    EMPTY_MARK,
    append_batch,
    begin_staging,
    commit_mark,
    committed_mark,
    read_staged,
    staged_mark,
)
from branchcost.sinks.writers import (
    reload_months,
    replace_periods,
    upsert_branch_salary,
    write_ordered,
    write_partitioned_overwrite,
)
from branchcost.sources import read_partitioned


@dataclass
class JobStatus:
    wrote: bool
    message: str = ""


def full_load(employees: DataFrame, timesheets: DataFrame) -> DataFrame:
    """branch_salary of all timesheets."""
    return branch_salary(timesheet_hours(timesheets), dedup_employees(employees))


def run_full_load(employees: DataFrame, timesheets: DataFrame, result_path: str) -> JobStatus:
    write_partitioned_overwrite(full_load(employees, timesheets), result_path)
    return JobStatus(True)


def salary_by_period(employees: DataFrame, timesheets: DataFrame) -> DataFrame:
    return salary_period(period_list(timesheets), employees_period_ready(employees))


def run_salary_period(employees: DataFrame, timesheets: DataFrame, result_path: str) -> JobStatus:
    write_ordered(salary_by_period(employees, timesheets), result_path, "year", "month", "branch_id")
    return JobStatus(True)


def run_incremental(
    spark: SparkSession,
    source_employees: DataFrame,
    source_timesheets: DataFrame,
    staging_employees_path: str,
    staging_timesheets_path: str,
    result_path: str,
    state_path: str | None = None,
    current_path: str | None = None,
) -> JobStatus:
    """Incremental load by high-water mark.

    1. employees joining after the employee staging table's mark are
       appended to it as one batch, whose latest join date is the next mark;
    2. timesheets dated from the first day of the month of the timesheet
       staging table's mark on form the delta, a filter with a literal on the
       source, which is read once, into the checkpoint folder;
    3. branch_salary of the delta (against the staged employees), written
       to the checkpoint folder as well, is upserted into the result by
       (branch_id, year, month);
    4. the delta's months are replaced in the timesheet staging table, and
       its latest date is committed as the next mark.

    With `state_path`, the seconds per employee and month of the delta, of
    which the branch figures are a roll-up, also replace their months in that
    table. It then holds what a full load needs of all timesheets
    (`run_full_from_state`). Its mark is committed before that of staging; a
    state whose mark is missing or older (loads ran without it) is made anew
    from the staged timesheets first.

    With `current_path`, the deduplicated employees are kept in that table
    (`sinks.current`): the new batch is merged into the buckets it touches,
    and the staging table is not deduplicated again.

    A mark is committed after the write that it stands for. A job that dies
    anywhere, also while files are being committed, and is run again sees the
    same marks, takes the same rows, and every write it repeats (the same
    batch, upsert of the same keys, overwrite of the same months) leaves the
    same end state.
    """
    for target in (staging_employees_path, staging_timesheets_path):
        begin_staging(spark, target)
    joined = staged_mark(spark, staging_employees_path, EMPLOYEES, "join_date")
    append_batch(employees_after(source_employees, joined), staging_employees_path, joined)
    if current_path:
        keep_current(spark, current_path, staging_employees_path)
        employees = current_employees(spark, current_path)
    else:
        employees = dedup_employees(read_staged(spark, staging_employees_path, EMPLOYEES))

    # the floor is a literal: nothing below reads the staging table
    staged = staged_mark(spark, staging_timesheets_path, STAGED_TIMESHEETS, "date")
    floor = staged.replace(day=1)
    if state_path:
        _ensure_state(spark, state_path, staging_timesheets_path, staged)
    with snapshot(timesheets_from(source_timesheets, floor), "timesheets") as ts_delta:
        with snapshot(employee_month_seconds(timesheet_hours(ts_delta)), "months") as months:
            with snapshot(branch_salary_of_months(months, employees), "delta") as delta:
                if delta.isEmpty():
                    return JobStatus(False, "no new data")
                upsert_branch_salary(delta, result_path)
            latest = reload_months(ts_delta, staging_timesheets_path, materialize=False)
            if state_path:
                replace_periods(months.select(*EMPLOYEE_MONTH.fieldNames()), state_path)
    if latest is not None:
        if state_path:
            commit_mark(spark, state_path, latest)
        commit_mark(spark, staging_timesheets_path, latest)
    return JobStatus(True)


def _ensure_state(spark: SparkSession, state_path: str, staging_timesheets_path: str, staged: dt.date) -> None:
    mark = committed_mark(spark, state_path)
    if staged > EMPTY_MARK and (mark is None or mark < staged):
        timesheets = read_partitioned(spark, staging_timesheets_path, TIMESHEETS)
        months = employee_month_seconds(timesheet_hours(timesheets)).select(*EMPLOYEE_MONTH.fieldNames())
        write_partitioned_overwrite(months, state_path)
        commit_mark(spark, state_path, staged)


def full_from_state(spark: SparkSession, state_path: str, employees: DataFrame) -> DataFrame:
    """branch_salary of all months in the employee-month state; no timesheet is read."""
    if committed_mark(spark, state_path) is None:
        raise ValueError(f"{state_path} holds no committed state; run an incremental load with it first")
    return branch_salary_of_months(read_partitioned(spark, state_path, EMPLOYEE_MONTH), dedup_employees(employees))


def run_full_from_state(spark: SparkSession, employees: DataFrame, state_path: str, result_path: str) -> JobStatus:
    """The full load's result from the state that the incremental loads keep.

    Gives every month the figures of today's employees, which the upserts of
    the incremental job do only for the months of their delta: a branch or
    salary that came later, for example. One row per employee and month is
    read in place of all timesheets.
    """
    result = full_from_state(spark, state_path, employees)
    write_partitioned_overwrite(result, result_path)
    return JobStatus(True)


def run_current_period(
    source_employees: DataFrame,
    source_timesheets: DataFrame,
    result_path: str,
    year: int | None = None,
    month: int | None = None,
) -> JobStatus:
    """Recompute one month and replace it in the result; year and month default to the current ones, each alone."""
    year, month = current_period(source_timesheets.sparkSession, year, month)
    ts = timesheets_in_period(source_timesheets, year, month)
    # a few rows per branch, so the source is read once and the guard asks what was written
    with snapshot(branch_salary(timesheet_hours(ts), dedup_employees(source_employees)), "period") as result:
        if result.isEmpty():
            return JobStatus(False, "no new data")
        replace_periods(result, result_path)
    return JobStatus(True)
