"""Column expressions shared by the operators.

Each helper takes column names and returns one built-in Spark expression,
written as Spark SQL text and turned into a Column by `F.expr`: the same
expression tree as the equivalent `pyspark.sql.functions` chain (it stays
inside whole-stage codegen; none of it is a UDF), but built with one JVM
call instead of dozens, which matters when every query rebuilds its plan.
The `*_sql` functions return the text, for composing larger expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the payroll rules.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\\z"  # as it stands in a SQL literal
CLOCK_PATTERN = r"^[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\\z"
DEFAULT_WORK_SECONDS = 8 * 3600  # 8 hours when a time is missing or not after checkin
STILL_EMPLOYED_DATE = "2900-01-01"  # resign date used for employees who have not resigned
EMPTY_WATERMARK_DATE = "1900-01-01"  # high-water mark of an empty staging table
LAST_JOIN_DAY = 28  # joining after this day of the month skips the month
FIRST_RESIGN_DAY = 1  # resigning on this day of the month skips the month


def q(name: str) -> str:
    """Quoted column reference."""
    return "`" + name.replace("`", "``") + "`"


def blank_sql(c: str) -> str:
    return f"({q(c)} IS NULL OR {q(c)} = '')"


def date_sql(c: str) -> str:
    """Text date (yyyy-MM-dd) to DATE; blank gives null, anything else fails the job.

    The cast alone would take partial dates and trailing text.
    """
    return (
        f"(CASE WHEN {blank_sql(c)} THEN NULL WHEN {q(c)} RLIKE '{DATE_PATTERN}' THEN CAST({q(c)} AS DATE)"
        f" ELSE raise_error(concat('malformed date: ', {q(c)})) END)"
    )


def clock_sql(date: str, clock: str) -> str:
    """Date text plus HH:mm:ss text to TIMESTAMP_NTZ; null when either is blank.

    TIMESTAMP_NTZ has no time zone, so no daylight-saving change can bend a
    span. Malformed text in either column fails the job.
    """
    return (
        f"(CASE WHEN {blank_sql(date)} OR {blank_sql(clock)} THEN NULL"
        f" WHEN {q(date)} RLIKE '{DATE_PATTERN}' AND {q(clock)} RLIKE '{CLOCK_PATTERN}'"
        f" THEN CAST(concat({q(date)}, ' ', {q(clock)}) AS TIMESTAMP_NTZ)"
        f" ELSE raise_error(concat('malformed date or time: ', {q(date)}, ' ', {q(clock)})) END)"
    )


def second_of_day_sql(ts: str) -> str:
    """Seconds since midnight of a TIMESTAMP_NTZ expression (no time zone involved)."""
    return f"(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"


def span_seconds_sql(start: str, end: str) -> str:
    """Wall-clock seconds from `start` to `end`, two TIMESTAMP_NTZ of one date.

    Computed from the clock fields, not with timestampdiff: Spark evaluates
    timestampdiff on TIMESTAMP_NTZ through the session time zone, which
    would bend a span across a daylight-saving change.
    """
    return f"CAST({second_of_day_sql(end)} - {second_of_day_sql(start)} AS BIGINT)"


def work_seconds_sql(checkin: str, checkout: str) -> str:
    """Seconds worked, from two columns that `clock_sql` has parsed."""
    i, o = q(checkin), q(checkout)
    return (
        f"(CASE WHEN {i} IS NULL OR {o} IS NULL OR {o} <= {i}"
        f" THEN CAST({DEFAULT_WORK_SECONDS} AS BIGINT) ELSE {span_seconds_sql(i, o)} END)"
    )


def is_blank(c: str) -> Column:
    """True for '' and for null: a CSV reader turns an empty field into null."""
    return F.expr(blank_sql(c))


def blank_to_null(c: str) -> Column:
    return F.expr(f"CASE WHEN NOT {blank_sql(c)} THEN {q(c)} END")


def null_to_blank(c: str) -> Column:
    return F.expr(f"coalesce({q(c)}, '')")


def parse_date(c: str) -> Column:
    """Text date (yyyy-MM-dd) to DATE; blank gives null (see `date_sql`)."""
    return F.expr(date_sql(c))


def parse_clock(date: str, clock: str) -> Column:
    """Date text plus HH:mm:ss text to TIMESTAMP_NTZ (see `clock_sql`)."""
    return F.expr(clock_sql(date, clock))


def work_seconds(checkin: str, checkout: str) -> Column:
    """Whole seconds worked between two parsed clock columns (TIMESTAMP_NTZ).

    8 hours when one is null or checkout is not after checkin, otherwise
    checkout minus checkin.
    """
    return F.expr(work_seconds_sql(checkin, checkout))


def seconds_to_hours(seconds: Column | str) -> Column:
    """Hours as DOUBLE from a whole-second total, divided once."""
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return c.cast("double") / F.lit(3600.0)


def year_of(c: str) -> Column:
    """Year (INT) of a DATE or TIMESTAMP column."""
    return F.expr(f"CAST(year({q(c)}) AS INT)")


def month_of(c: str) -> Column:
    """Month (INT) of a DATE or TIMESTAMP column."""
    return F.expr(f"CAST(month({q(c)}) AS INT)")


def year_of_text(c: str) -> Column:
    """Year (INT) of a yyyy-MM-dd text column; null when blank."""
    return F.expr(f"CAST(year({date_sql(c)}) AS INT)")


def month_of_text(c: str) -> Column:
    """Month (INT) of a yyyy-MM-dd text column; null when blank."""
    return F.expr(f"CAST(month({date_sql(c)}) AS INT)")


def month_start(year: str, month: str) -> Column:
    return F.expr(f"make_date({q(year)}, {q(month)}, 1)")


def first_month_employed(join_date: str) -> Column:
    """First day of the first month in which an employee counts.

    An employee counts in a month when the join date (a DATE column) is on
    or before the 28th of that month.
    """
    j = q(join_date)
    return F.expr(
        f"CASE WHEN dayofmonth({j}) <= {LAST_JOIN_DAY} THEN trunc({j}, 'MM')"
        f" ELSE add_months(trunc({j}, 'MM'), 1) END"
    )


def last_month_employed(resign_date: str) -> Column:
    """First day of the last month in which an employee counts.

    An employee counts in a month when the resign date (a DATE column) is
    after the 1st of that month.
    """
    r = q(resign_date)
    return F.expr(
        f"CASE WHEN dayofmonth({r}) > {FIRST_RESIGN_DAY} THEN trunc({r}, 'MM')"
        f" ELSE add_months(trunc({r}, 'MM'), -1) END"
    )
