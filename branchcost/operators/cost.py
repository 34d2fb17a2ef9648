"""Branch cost per month: hours, salary and salary per hour.

The flagship result is computed in two aggregation levels instead of the
original self-join of two aggregates:

1. timesheet hours summed per (employee_id, year, month). The partial
   aggregate runs before the shuffle, so one employee with a huge share
   of the timesheets leaves every map task as one row per month.
2. that pre-aggregate joined (left) to the deduplicated employees on
   employee_id, then summed per (branch_id, year, month).

Deduplication makes branch and salary functions of the employee, so one
row per employee and month carries both the hours and the salary that the
original counted once per distinct (branch, month, employee, salary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchcost.functions import seconds_to_hours
from branchcost.schemas import BRANCH_SALARY_COLUMNS, BRANCH_SALARY_KEY
from branchcost.session import materialize


def employee_month_seconds(hours: DataFrame) -> DataFrame:
    """Seconds worked per (employee_id, year, month); partial-aggregated map-side."""
    return hours.groupBy("employee_id", "year", "month").agg(F.sum("work_seconds").alias("work_seconds"))


def attach_employee(left: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """Left join on employee_id: unmatched rows keep null branch and salary.

    No join strategy is forced: AQE broadcasts the employee side only when
    its measured size is under the broadcast threshold, and falls back to a
    sort-merge join on employee_id otherwise.
    """
    emp = employees_dedup.select(
        F.col("employe_id").alias("_emp_id"), "branch_id", "salary"
    )
    return left.join(emp, left["employee_id"] == emp["_emp_id"], "left").drop("_emp_id")


def timesheet_employee(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """Every timesheet row with its employee's branch and salary (row level).

    The deduplicated employees are written once and read back, so that both
    sides of the join come from plain shuffles: with the dedup window between
    shuffle and join, the adaptive skew join would not split the timesheets
    of one employee with very many.
    """
    return attach_employee(hours, materialize(employees_dedup, "employees")).select(
        "timesheet_id", "employee_id", "branch_id", "salary", "year", "month", "work_hour"
    )


def employee_month(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """One row per (employee, year, month) with seconds, branch and salary."""
    return attach_employee(employee_month_seconds(hours), employees_dedup)


def work_hour_by_branch_month(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """Total hours per (branch_id, year, month)."""
    return (
        employee_month(hours, employees_dedup)
        .groupBy(*BRANCH_SALARY_KEY)
        .agg(seconds_to_hours(F.sum("work_seconds")).alias("total_work_hour"))
    )


def salary_base_distinct(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """Distinct (branch_id, year, month, employee_id, salary) of the joined timesheets."""
    return employee_month(hours, employees_dedup).select(
        "branch_id", "year", "month", "employee_id", "salary"
    )


def branch_salary_month(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """Employees paid and salary paid per (branch_id, year, month)."""
    return (
        salary_base_distinct(hours, employees_dedup)
        .groupBy(*BRANCH_SALARY_KEY)
        .agg(
            F.count("employee_id").alias("total_employee"),
            F.sum(F.col("salary").cast("long")).alias("total_salary"),
        )
    )


def branch_salary(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """branch_id, year, month, total_work_hour, total_salary, cost_per_hour."""
    return branch_salary_of_months(employee_month_seconds(hours), employees_dedup)


def branch_salary_of_months(months: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """`branch_salary` rolled up from seconds per (employee_id, year, month).

    A null branch keeps its hours but gets null salary figures, as an
    equality join on a null branch finds no salary row.
    """
    salary = F.when(F.col("branch_id").isNotNull(), F.col("salary").cast("long"))
    return (
        attach_employee(months, employees_dedup)
        .groupBy(*BRANCH_SALARY_KEY)
        .agg(
            seconds_to_hours(F.sum("work_seconds")).alias("total_work_hour"),
            F.sum(salary).alias("total_salary"),
        )
        .withColumn("cost_per_hour", F.col("total_salary") / F.col("total_work_hour"))
        .select(*BRANCH_SALARY_COLUMNS)
    )


def branch_salary_self_join(hours: DataFrame, employees_dedup: DataFrame) -> DataFrame:
    """Hours per branch-month left-joined to salary per branch-month.

    Two aggregates of the same pre-aggregate, kept to check the two-level
    form against; jobs use `branch_salary`.
    """
    work = work_hour_by_branch_month(hours, employees_dedup)
    pay = branch_salary_month(hours, employees_dedup).select(
        *[F.col(c).alias(f"_p_{c}") for c in BRANCH_SALARY_KEY], "total_salary"
    )
    cond = [work[c] == pay[f"_p_{c}"] for c in BRANCH_SALARY_KEY]
    return (
        work.join(pay, cond, "left")
        .withColumn("cost_per_hour", F.col("total_salary") / F.col("total_work_hour"))
        .select(*BRANCH_SALARY_COLUMNS)
    )
