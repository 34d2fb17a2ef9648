"""Relational operators of the payroll model, each a DataFrame -> DataFrame transform."""

from branchcost.operators.cost import (
    attach_employee,
    branch_salary,
    branch_salary_month,
    branch_salary_of_months,
    branch_salary_self_join,
    employee_month,
    employee_month_seconds,
    salary_base_distinct,
    timesheet_employee,
    work_hour_by_branch_month,
)
from branchcost.operators.employees import dedup_employees, duplicate_ids, employees_period_ready
from branchcost.operators.hours import (
    timesheet_bad,
    timesheet_cleansing,
    timesheet_good,
    timesheet_hours,
    timesheet_hours_literal,
)
from branchcost.operators.incremental import (
    current_period,
    employees_after,
    employees_delta,
    high_water_mark,
    high_water_marks,
    lookup_existing,
    merge_branch_salary,
    timesheets_delta,
    timesheets_from,
    timesheets_in_period,
)
from branchcost.operators.periods import (
    employee_months,
    period_employee_exploded,
    period_employee_range_join,
    period_list,
    salary_period,
)

__all__ = [
    "attach_employee",
    "branch_salary",
    "branch_salary_month",
    "branch_salary_of_months",
    "branch_salary_self_join",
    "current_period",
    "dedup_employees",
    "duplicate_ids",
    "employee_month",
    "employee_month_seconds",
    "employee_months",
    "employees_after",
    "employees_delta",
    "employees_period_ready",
    "high_water_mark",
    "high_water_marks",
    "lookup_existing",
    "merge_branch_salary",
    "period_employee_exploded",
    "period_employee_range_join",
    "period_list",
    "salary_base_distinct",
    "salary_period",
    "timesheet_bad",
    "timesheet_cleansing",
    "timesheet_employee",
    "timesheet_good",
    "timesheet_hours",
    "timesheet_hours_literal",
    "timesheets_delta",
    "timesheets_from",
    "timesheets_in_period",
    "work_hour_by_branch_month",
]
