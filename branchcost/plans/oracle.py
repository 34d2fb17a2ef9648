"""DuckDB statements for every registered query, from the payroll rules.

Three building blocks, each a common table expression over the bindings
(`employees`, `timesheets`):

* `worked`: seconds per timesheet, and their year and month;
* `person`: one row per employee id (`DISTINCT ON`, highest salary first);
* `cost`: totals per employee and month first, then per branch.

Employment months are counted as month numbers (year * 12 + month).
"""

from __future__ import annotations

from branchcost.plans.catalog import EMPLOYEE_CUT, PERIOD, PLANTED_ROW, TIMESHEET_CUT
from branchcost.sources.bindings import BINDINGS_SQL

EIGHT_HOURS = 8 * 3600


def day(c: str) -> str:
    return f"strptime({c}, '%Y-%m-%d')::DATE"


def moment(clock: str) -> str:
    """Date and clock text to a timestamp; null when the clock is blank."""
    return f"strptime(date || ' ' || nullif({clock}, ''), '%Y-%m-%d %H:%M:%S')"


def worked(name: str, source: str = "timesheets", both_blank: int = EIGHT_HOURS) -> str:
    span = f"date_diff('second', {moment('checkin')}, {moment('checkout')})"
    return f""", {name} AS (
    SELECT timesheet_id, employee_id,
           year({day('date')})::INTEGER AS year, month({day('date')})::INTEGER AS month,
           (CASE WHEN checkin = '' AND checkout = '' THEN {both_blank}
                 WHEN {span} > 0 THEN {span} ELSE {EIGHT_HOURS} END)::BIGINT AS work_seconds
    FROM {source}
)"""


def person(name: str, source: str = "employees") -> str:
    return f""", {name} AS (
    SELECT DISTINCT ON (employe_id) employe_id, branch_id, salary, join_date, resign_date
    FROM {source}
    ORDER BY employe_id, salary DESC NULLS LAST, branch_id NULLS LAST, join_date NULLS LAST, resign_date NULLS LAST
)"""


def person_month(name: str, hours: str, people: str) -> str:
    """One row per employee id and month: seconds, branch and salary."""
    return f""", {name} AS (
    SELECT w.employee_id, w.year, w.month, p.branch_id, p.salary, w.total AS work_seconds
    FROM (SELECT employee_id, year, month, sum(work_seconds) AS total FROM {hours} GROUP BY ALL) w
    LEFT JOIN {people} p ON p.employe_id = w.employee_id
)"""


def cost(name: str, months: str) -> str:
    return f""", {name} AS (
    SELECT branch_id, year, month, total_work_hour, total_salary,
           total_salary / total_work_hour AS cost_per_hour
    FROM (
        SELECT branch_id, year, month, sum(work_seconds)::DOUBLE / 3600.0 AS total_work_hour,
               (sum(salary) FILTER (branch_id IS NOT NULL))::BIGINT AS total_salary
        FROM {months} GROUP BY branch_id, year, month
    )
)"""


def chain(prefix: str, timesheets: str, employees: str) -> str:
    """All of the above for one pair of inputs: `{prefix}_cost` and what it is made of."""
    return (
        worked(f"{prefix}_worked", timesheets)
        + person(f"{prefix}_person", employees)
        + person_month(f"{prefix}_months", f"{prefix}_worked", f"{prefix}_person")
        + cost(f"{prefix}_cost", f"{prefix}_months")
    )


#: Rows with their blanks told apart: a row without both times counts as both kinds.
KINDS = f""", kinds AS (
    SELECT timesheet_id, employee_id, {day('date')} AS date, kind,
           CASE WHEN kind <> 'no checkin' THEN coalesce({moment('checkin')}, {day('date')}::TIMESTAMP) END AS checkin,
           CASE WHEN kind <> 'no checkout' THEN coalesce({moment('checkout')}, {day('date')}::TIMESTAMP) END AS checkout
    FROM timesheets, (VALUES ('both'), ('no checkin'), ('no checkout')) AS k(kind)
    WHERE CASE kind WHEN 'both' THEN checkin <> '' AND checkout <> ''
                    WHEN 'no checkin' THEN checkin = '' ELSE checkout = '' END
)"""
KIND_COLUMNS = "timesheet_id, employee_id, date, checkin, checkout"

#: Calendar of the timesheets and the months in which each employee counts.
EMPLOYMENT = (
    person("person")
    + f""", ready AS (
    SELECT * REPLACE (coalesce(nullif(resign_date, ''), '2900-01-01') AS resign_date) FROM person
), calendar AS (
    SELECT DISTINCT year({day('date')})::INTEGER AS year, month({day('date')})::INTEGER AS month FROM timesheets
), tenure AS (
    SELECT employe_id, branch_id, salary,
           year(f) * 12 + month(f) + (day(f) > 28)::INTEGER AS first_month,
           year(l) * 12 + month(l) - (day(l) <= 1)::INTEGER AS last_month
    FROM (SELECT *, {day('join_date')} AS f, {day('resign_date')} AS l FROM ready)
), employed AS (
    SELECT c.year, c.month, t.employe_id, t.branch_id, t.salary
    FROM calendar c LEFT JOIN tenure t ON c.year * 12 + c.month BETWEEN t.first_month AND t.last_month
)"""
)


def latest(column: str, source: str) -> str:
    return f"(SELECT coalesce(max({day(column)}), DATE '1900-01-01') FROM {source})"


#: The incremental keys: what is staged, what is new, and the results of both.
INCREMENT = (
    f""", staged_timesheets AS (
    FROM timesheets WHERE date <= '{TIMESHEET_CUT}'
), staged_employees AS (
    FROM employees WHERE join_date <= '{EMPLOYEE_CUT}'
), new_employees AS (
    FROM employees WHERE {day('join_date')} > {latest('join_date', 'staged_employees')}
), new_timesheets AS (
    FROM timesheets WHERE {day('date')} >= date_trunc('month', {latest('date', 'staged_timesheets')})
), known_employees AS (
    FROM staged_employees UNION ALL FROM new_employees
), month_timesheets AS (
    FROM timesheets WHERE date LIKE '{PERIOD[0]:04d}-{PERIOD[1]:02d}-%'
)"""
    + chain("before", "staged_timesheets", "staged_employees")
    + chain("delta", "new_timesheets", "known_employees")
    + chain("period", "month_timesheets", "employees")
    + f""", existing AS (
    FROM before_cost UNION ALL VALUES ({', '.join(map(str, PLANTED_ROW))})
)"""
)
SAME_KEY = "(d.branch_id, d.year, d.month) IS NOT DISTINCT FROM (e.branch_id, e.year, e.month)"


def oracle_sql() -> dict[str, str]:
    year, month = PERIOD
    full = chain("all", "timesheets", "employees")
    literal = (
        worked("w", both_blank=2 * EIGHT_HOURS) + person("p") + person_month("m", "w", "p") + cost("c", "m")
    )
    hours = "work_seconds::DOUBLE / 3600.0 AS work_hour"
    touched = f"EXISTS (FROM delta_cost d WHERE {SAME_KEY})"
    texts = {
        "branch_salary_full": full + "FROM all_cost",
        "branch_salary_union_literal": literal + "FROM c",
        "branch_salary_self_join": full + "FROM all_cost",
        "timesheet_cleansing": f"{KINDS} SELECT {KIND_COLUMNS} FROM kinds",
        "timesheet_bad": f"{KINDS} SELECT {KIND_COLUMNS} FROM kinds WHERE kind <> 'both' OR checkout <= checkin",
        "timesheet_good": f"{KINDS} SELECT {KIND_COLUMNS} FROM kinds WHERE kind = 'both' AND checkout > checkin",
        "timesheet_work_hours": worked("w") + f"SELECT *, {hours} FROM w",
        "employees_dedup": person("p") + "FROM p",
        "employees_current": person("p") + "FROM p",
        "employees_duplicate_ids": " SELECT employe_id, count(*) AS n FROM employees GROUP BY 1 HAVING n > 1",
        "employees_period_ready": EMPLOYMENT + "FROM ready",
        "timesheet_employee": worked("w") + person("p") + f"""
SELECT w.timesheet_id, w.employee_id, p.branch_id, p.salary, w.year, w.month, {hours}
FROM w LEFT JOIN p ON p.employe_id = w.employee_id""",
        "work_hour_by_branch_month": full + "SELECT branch_id, year, month, total_work_hour FROM all_cost",
        "salary_base_distinct": full + "SELECT branch_id, year, month, employee_id, salary FROM all_months",
        "branch_salary_month": full + """
SELECT branch_id, year, month, count(employee_id) AS total_employee, sum(salary)::BIGINT AS total_salary
FROM all_months GROUP BY ALL""",
        "period_list": EMPLOYMENT + "FROM calendar ORDER BY year, month",
        "period_employee_range_join": EMPLOYMENT + "FROM employed",
        "period_employee_exploded": EMPLOYMENT + "FROM employed",
        "salary_period": EMPLOYMENT + """
SELECT year, month, branch_id, sum(salary)::BIGINT AS "sum" FROM employed
GROUP BY ALL ORDER BY year, month, branch_id NULLS LAST""",
        "high_water_marks": INCREMENT + f"""
SELECT 'employees' AS table_name, {latest('join_date', 'staged_employees')} AS max_date
UNION ALL SELECT 'timesheets', {latest('date', 'staged_timesheets')}
UNION ALL SELECT 'timesheets_empty', {latest('date', "(FROM timesheets WHERE date < '1900-01-01')")}""",
        "employees_delta": INCREMENT + "FROM new_employees",
        "timesheets_delta": INCREMENT + "FROM new_timesheets",
        "timesheets_current_period": INCREMENT + "FROM month_timesheets",
        "branch_salary_lookup": INCREMENT + f"FROM existing e WHERE {touched}",
        "branch_salary_upsert": INCREMENT + f"FROM existing e WHERE NOT {touched} UNION ALL FROM delta_cost",
        "branch_salary_period_replace": INCREMENT + f"""
FROM existing WHERE (year, month) IS DISTINCT FROM ({year}, {month}) UNION ALL FROM period_cost""",
        "employees_csv_scan": " FROM employees",
        "timesheets_csv_scan": " FROM timesheets",
        "sink_full_overwrite": full + "FROM all_cost",
        "branch_salary_from_state": full + "FROM all_cost",
        "sink_staging_append": INCREMENT + "FROM known_employees",
        "sink_staging_month_reload": " FROM timesheets",
    }
    # the same values, found in the partitions of staged tables
    texts["high_water_marks_staged"] = texts["high_water_marks"]
    texts["period_list_staged"] = texts["period_list"]
    return {key: f"{BINDINGS_SQL}{text}" for key, text in texts.items()}
