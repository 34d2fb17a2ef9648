"""Built-in column expressions for dates, clock times and hours."""

from branchcost.functions.columns import (
    DEFAULT_WORK_SECONDS,
    EMPTY_WATERMARK_DATE,
    STILL_EMPLOYED_DATE,
    blank_to_null,
    first_month_employed,
    is_blank,
    last_month_employed,
    month_of,
    month_of_text,
    month_start,
    null_to_blank,
    parse_clock,
    parse_date,
    seconds_to_hours,
    work_seconds,
    year_of,
    year_of_text,
)

__all__ = [
    "DEFAULT_WORK_SECONDS",
    "EMPTY_WATERMARK_DATE",
    "STILL_EMPLOYED_DATE",
    "blank_to_null",
    "first_month_employed",
    "is_blank",
    "last_month_employed",
    "month_of",
    "month_of_text",
    "month_start",
    "null_to_blank",
    "parse_clock",
    "parse_date",
    "seconds_to_hours",
    "work_seconds",
    "year_of",
    "year_of_text",
]
