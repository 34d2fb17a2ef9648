"""Random inputs against a brute-force evaluation of the payroll rules.

The brute force works row by row in plain Python on the same rows; the
engine must agree exactly (hours are whole seconds / 3600 in both).
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from branchcost.operators import employees_period_ready, period_employee_range_join, period_list
from branchcost.plans.jobs import full_load, salary_by_period
from branchcost.schemas import EMPLOYEES, TIMESHEETS

DAY0 = dt.date(2019, 1, 1)

dates = st.integers(0, 500).map(lambda d: (DAY0 + dt.timedelta(days=d)).isoformat())
clock = st.one_of(
    st.just(""),
    st.none(),
    st.tuples(st.integers(0, 23), st.integers(0, 59), st.integers(0, 59)).map(lambda t: "%02d:%02d:%02d" % t),
)
employee_rows = st.lists(
    st.tuples(
        st.integers(1, 8),
        st.sampled_from([1, 2, 3, None]),
        st.integers(10, 30).map(lambda k: k * 500_000),
        dates,
        st.one_of(st.just(""), dates),
    ),
    min_size=1,
    max_size=14,
)
# employee 1 is hot: about a third of the timesheets or more
timesheet_rows = st.lists(
    st.tuples(
        st.one_of(st.just(1), st.integers(1, 11), st.none()),
        dates,
        clock,
        clock,
    ),
    min_size=1,
    max_size=40,
)


def _blank(v):
    return v is None or v == ""


def _dedup(emps):
    best = {}
    for e in emps:
        key = (
            e[2] is None, -(e[2] or 0),
            e[1] is None, e[1] or 0,
            e[3] is None, e[3] or "",
            e[4] is None, e[4] or "",
        )
        if e[0] not in best or key < best[e[0]][0]:
            best[e[0]] = (key, e)
    return {k: v[1] for k, v in best.items()}


def _seconds(date, cin, cout):
    if _blank(cin) or _blank(cout):
        return 8 * 3600
    a = dt.datetime.fromisoformat(f"{date} {cin}")
    b = dt.datetime.fromisoformat(f"{date} {cout}")
    return int((b - a).total_seconds()) if b > a else 8 * 3600


def brute_branch_salary(emps, tss):
    emp = _dedup(emps)
    secs, paid = {}, {}
    for _, eid, date, cin, cout in tss:
        e = emp.get(eid)
        branch, salary = (e[1], e[2]) if e else (None, None)
        d = dt.date.fromisoformat(date)
        key = (branch, d.year, d.month)
        secs[key] = secs.get(key, 0) + _seconds(date, cin, cout)
        paid.setdefault(key, {})[eid] = salary
    out = set()
    for key, s in secs.items():
        hours = s / 3600.0
        salaries = [v for v in paid[key].values() if v is not None]
        total = sum(salaries) if salaries and key[0] is not None else None
        out.add((*key, hours, total, None if total is None else total / hours))
    return out


def brute_salary_period(emps, tss):
    emp = _dedup(emps)
    periods = {(dt.date.fromisoformat(t[2]).year, dt.date.fromisoformat(t[2]).month) for t in tss}
    out = set()
    for y, m in periods:
        sums = {}
        for e in emp.values():
            resign = e[4] if not _blank(e[4]) else "2900-01-01"
            if e[3] <= dt.date(y, m, 28).isoformat() and resign > dt.date(y, m, 1).isoformat():
                sums.setdefault(e[1], []).append(e[2])
        if not sums:
            out.add((y, m, None, None))
        for branch, vals in sums.items():
            out.add((y, m, branch, sum(vals)))
    return out


def _frames(spark, emps, ts_rows):
    tss = [(i, eid, date, cin, cout) for i, (eid, date, cin, cout) in enumerate(ts_rows)]
    return spark.createDataFrame(emps, EMPLOYEES), spark.createDataFrame(tss, TIMESHEETS), tss


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(emps=employee_rows, ts_rows=timesheet_rows)
def test_branch_salary_matches_brute_force(spark, emps, ts_rows):
    emp_df, ts_df, tss = _frames(spark, emps, ts_rows)
    got = {tuple(r) for r in full_load(emp_df, ts_df).collect()}
    assert got == brute_branch_salary(emps, tss)


@SETTINGS
@given(emps=employee_rows, ts_rows=timesheet_rows)
def test_salary_period_matches_brute_force(spark, emps, ts_rows):
    emp_df, ts_df, tss = _frames(spark, emps, ts_rows)
    got = {tuple(r) for r in salary_by_period(emp_df, ts_df).collect()}
    assert got == brute_salary_period(emps, tss)
    pairs = period_employee_range_join(period_list(ts_df), employees_period_ready(emp_df))
    assert {(r.year, r.month) for r in pairs.collect()} == {(y, m) for y, m, _, _ in got}
