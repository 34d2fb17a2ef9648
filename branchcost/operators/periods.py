"""Salary of everyone employed in a month, from join and resign dates.

An employee counts in month M when the join date is on or before the 28th
of M and the resign date is after the 1st of M.

The range join of periods and employees is planned as an equi-join: each
employee expands to the months it is employed within the span of the period
list (bounds come from one scalar subquery), and these months are joined to
the list on (year, month).

`salary_period` sums per (year, month, branch) map-side, in the same stage
as the expansion, so the only shuffled rows are one
per month and branch; the period list is then left-joined to keep months
that no employee covers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchcost.functions import (
    first_month_employed,
    last_month_employed,
    month_of,
    month_of_text,
    month_start,
    parse_date,
    year_of,
    year_of_text,
)
from branchcost.schemas import PERIOD_KEY, SALARY_PERIOD_COLUMNS

PAIR_COLUMNS = ["year", "month", "employe_id", "branch_id", "salary"]


def period_list(timesheets: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct (year, month) of the timesheet dates; sorted with `ordered`.

    Only the date column is read, and the partial distinct before the
    shuffle leaves one row per month and input partition. Sorting is left
    to the caller that needs it: inside a join it would only add a
    range-partitioning job.
    """
    periods = timesheets.select(year_of_text("date").alias("year"), month_of_text("date").alias("month")).distinct()
    if ordered:
        periods = periods.orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())
    return periods


def _employee_dates(employees_ready: DataFrame) -> DataFrame:
    return employees_ready.select(
        "employe_id",
        "branch_id",
        "salary",
        parse_date("join_date").alias("_join"),
        parse_date("resign_date").alias("_resign"),
    )


def _period_bounds(periods: DataFrame) -> tuple[Column, Column]:
    """First and last month of the period list, as one scalar subquery."""
    starts = periods.select(month_start("year", "month").alias("_s"))
    bounds = starts.select(F.struct(F.min("_s").alias("lo"), F.max("_s").alias("hi"))).scalar()
    return bounds.getField("lo"), bounds.getField("hi")


def employee_months(periods: DataFrame, employees_ready: DataFrame) -> DataFrame:
    """(year, month, employe_id, branch_id, salary) for every month an employee counts.

    Months are clipped to the first and last month of the period list, so
    an open-ended employment expands only over the span of the data.
    """
    lo, hi = _period_bounds(periods)
    # greatest/least skip nulls: without periods (null bounds) nothing may expand
    e = _employee_dates(employees_ready).filter(
        F.col("_join").isNotNull() & F.col("_resign").isNotNull() & lo.isNotNull() & hi.isNotNull()
    )
    first = F.greatest(first_month_employed("_join"), lo)
    last = F.least(last_month_employed("_resign"), hi)
    months = (
        e.select("employe_id", "branch_id", "salary", first.alias("_first"), last.alias("_last"))
        .filter(F.col("_first") <= F.col("_last"))
        .select(
            "employe_id",
            "branch_id",
            "salary",
            F.explode(F.sequence("_first", "_last", F.make_ym_interval(F.lit(0), F.lit(1)))).alias("_m"),
        )
    )
    return months.select(
        year_of("_m").alias("year"), month_of("_m").alias("month"), "employe_id", "branch_id", "salary"
    )


def period_employee_exploded(periods: DataFrame, employees_ready: DataFrame) -> DataFrame:
    """periods LEFT JOIN employees ON join date <= day 28 AND resign date > day 1.

    One row per listed period and employee that counts in it, and one row
    without an employee for a period that nobody covers. The months of the
    employees are the large side: they stream past the short period list
    (an inner join, so AQE may broadcast the list or split a hot month), and
    the periods that are not covered are added by an anti-join with the
    covered months, which are summed up before they are shuffled.
    """
    months = employee_months(periods, employees_ready)
    pairs = months.join(periods, PERIOD_KEY).select(*PAIR_COLUMNS)
    covered = months.select(*PERIOD_KEY).distinct()
    uncovered = periods.join(covered, PERIOD_KEY, "left_anti").selectExpr(
        *PERIOD_KEY, *[f"CAST(NULL AS INT) AS {c}" for c in PAIR_COLUMNS[len(PERIOD_KEY):]]
    )
    return pairs.unionByName(uncovered)


def period_employee_range_join(periods: DataFrame, employees_ready: DataFrame) -> DataFrame:
    """The range join of the rules; planned as `period_employee_exploded`, with no nested loop."""
    return period_employee_exploded(periods, employees_ready)


def salary_period(periods: DataFrame, employees_ready: DataFrame) -> DataFrame:
    """year, month, branch_id, sum: salary of everyone employed per month and branch.

    A period that no employee covers gives one row with null branch and sum.
    """
    per_branch = (
        employee_months(periods, employees_ready)
        .groupBy("year", "month", "branch_id")
        .agg(F.sum(F.col("salary").cast("long")).alias("sum"))
    )
    return (
        periods.join(per_branch, PERIOD_KEY, "left")
        .select(*SALARY_PERIOD_COLUMNS)
        .orderBy(
            F.col("year").asc_nulls_last(),
            F.col("month").asc_nulls_last(),
            F.col("branch_id").asc_nulls_last(),
        )
    )
