"""Golden mini-set: the 8-hour rule, deduplication, null branch, boundary days."""

from pyspark.sql import functions as F

from branchcost.operators import (
    branch_salary,
    branch_salary_self_join,
    dedup_employees,
    duplicate_ids,
    employees_period_ready,
    period_employee_exploded,
    period_employee_range_join,
    period_list,
    salary_period,
    timesheet_hours,
    timesheet_hours_literal,
)
from branchcost.plans.jobs import full_load, salary_by_period
from fixtures import (
    EXPECTED_BRANCH_SALARY,
    EXPECTED_LITERAL_DIFF,
    EXPECTED_SALARY_PERIOD,
    as_dict,
    golden_employees,
    golden_timesheets,
)

KEY = ["branch_id", "year", "month"]
VALUES = ["total_work_hour", "total_salary", "cost_per_hour"]


def test_branch_salary_golden(spark):
    got = as_dict(full_load(golden_employees(spark), golden_timesheets(spark)), KEY, VALUES)
    assert got == EXPECTED_BRANCH_SALARY


def test_self_join_form_equals_two_level_form(spark):
    hours = timesheet_hours(golden_timesheets(spark))
    emp = dedup_employees(golden_employees(spark))
    assert as_dict(branch_salary_self_join(hours, emp), KEY, VALUES) == EXPECTED_BRANCH_SALARY


def test_literal_union_counts_both_blank_twice(spark):
    hours = timesheet_hours_literal(golden_timesheets(spark))
    got = as_dict(branch_salary(hours, dedup_employees(golden_employees(spark))), KEY, VALUES)
    expected = dict(EXPECTED_BRANCH_SALARY)
    expected.update(EXPECTED_LITERAL_DIFF)
    assert got == expected


def test_eight_hour_rule_per_row(spark):
    hours = {r.timesheet_id: r.work_seconds for r in timesheet_hours(golden_timesheets(spark)).collect()}
    assert hours[101] == 9.5 * 3600
    assert hours[102] == hours[103] == hours[104] == 8 * 3600  # blanks
    assert hours[105] == 8 * 3600  # overnight
    assert hours[106] == 8 * 3600  # equal times
    assert hours[108] == 12
    assert hours[112] == 8.5 * 3600


def test_null_time_is_treated_as_blank(spark):
    ts = golden_timesheets(spark).filter(F.col("timesheet_id") == 101).withColumn(
        "checkout", F.lit(None).cast("string")
    )
    assert timesheet_hours(ts).first().work_seconds == 8 * 3600


def test_dedup_keeps_numeric_highest_salary(spark):
    emp = {r.employe_id: r.salary for r in dedup_employees(golden_employees(spark)).collect()}
    assert emp[50] == 10000000  # '9500000' > '10000000' as text; numeric order wins
    assert len(emp) == 6


def test_duplicate_ids(spark):
    assert [(r.employe_id, r.n) for r in duplicate_ids(golden_employees(spark)).collect()] == [(50, 2)]


def test_period_ready_defaults_resign_date(spark):
    emp = {r.employe_id: r.resign_date for r in employees_period_ready(golden_employees(spark)).collect()}
    assert emp[1] == "2900-01-01" and emp[9] == "2019-08-01"


def test_salary_period_golden(spark):
    got = {tuple(r) for r in salary_by_period(golden_employees(spark), golden_timesheets(spark)).collect()}
    assert got == EXPECTED_SALARY_PERIOD


def test_salary_period_is_ordered_nulls_last(spark):
    rows = [tuple(r) for r in salary_by_period(golden_employees(spark), golden_timesheets(spark)).collect()]
    assert rows[3] == (2019, 8, None, 5000000) and rows[-1] == (2019, 9, None, 5000000)


def test_range_join_equals_exploded_join(spark):
    periods = period_list(golden_timesheets(spark))
    emp = employees_period_ready(golden_employees(spark))
    a = sorted(map(tuple, period_employee_range_join(periods, emp).collect()), key=str)
    b = sorted(map(tuple, period_employee_exploded(periods, emp).collect()), key=str)
    assert a == b and len(a) == 9  # Aug: 1, 50, 60, 70; Sep: 1, 33, 50, 60, 70


def test_period_without_employees_keeps_null_row(spark):
    emp = employees_period_ready(golden_employees(spark))
    ts = spark.createDataFrame([(1, 1, "2010-03-05", "08:00:00", "17:00:00")], golden_timesheets(spark).schema)
    got = [tuple(r) for r in salary_period(period_list(ts), emp).collect()]
    assert got == [(2010, 3, None, None)]
    pairs = [tuple(r) for r in period_employee_range_join(period_list(ts), emp).collect()]
    assert pairs == [(2010, 3, None, None, None)]


def test_employees_loaded_twice_dedup_to_the_same_rows(spark):
    """A seed script that inserts the same employee rows twice must not change the result."""
    from branchcost.sources import load_employees
    from conftest import SF_SMALL

    emp = load_employees(spark, SF_SMALL)
    once = sorted(map(tuple, dedup_employees(emp).collect()), key=str)
    twice = sorted(map(tuple, dedup_employees(emp.unionByName(emp)).collect()), key=str)
    assert once == twice
    assert len(once) == emp.select("employe_id").distinct().count()
    # every kept row carries the highest salary of its id
    top = {r.employe_id: r.top for r in emp.groupBy("employe_id").agg(F.max("salary").alias("top")).collect()}
    assert all(row[2] == top[row[0]] for row in once)


def test_no_timesheets_gives_no_periods_and_expands_nothing(spark):
    from branchcost.operators import employee_months

    emp = employees_period_ready(golden_employees(spark))
    no_ts = golden_timesheets(spark).filter(F.lit(False))
    assert employee_months(period_list(no_ts), emp).count() == 0
    assert salary_by_period(golden_employees(spark), no_ts).count() == 0


def test_sql_views_give_the_job_results(spark):
    from branchcost.plans.views import register_views

    register_views(spark, golden_employees(spark), golden_timesheets(spark))
    rows = spark.sql(
        "SELECT branch_id, year, month, total_work_hour, total_salary, cost_per_hour FROM branch_salary"
    ).collect()
    assert {(r[0], r[1], r[2]): (r[3], r[4], r[5]) for r in rows} == EXPECTED_BRANCH_SALARY
    got = {tuple(r) for r in spark.sql("SELECT year, month, branch_id, `sum` FROM salary_period").collect()}
    assert got == EXPECTED_SALARY_PERIOD


def test_hours_do_not_depend_on_the_session_time_zone(spark):
    """A shift across a daylight-saving change counts its wall-clock span."""
    from branchcost.operators import timesheet_hours, timesheet_hours_literal

    ts = spark.createDataFrame(
        [(1, 1, "2019-03-10", "01:30:00", "03:30:00"), (2, 1, "2019-11-03", "00:30:00", "02:30:00")],
        golden_timesheets(spark).schema,
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Europe/Berlin", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.work_seconds for r in timesheet_hours(ts).orderBy("timesheet_id").collect()] == [7200, 7200]
            assert sorted(r.work_seconds for r in timesheet_hours_literal(ts).collect()) == [7200, 7200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
