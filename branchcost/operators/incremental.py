"""High-water marks, deltas, the current-period filter and the result merge.

A high-water mark is a one-row aggregate. Its value becomes a literal in
the delta's filter, so the filter is pushed to the source's scan and later
steps do not read the staging table again.

Text ranges on date columns go by the year only ('2019' <= date): dates are
strict yyyy-MM-dd, so a year's dates sort together as text, and malformed
text of that year stays in reach of the parser, which stops the job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchcost.functions import EMPTY_WATERMARK_DATE, parse_date
from branchcost.schemas import BRANCH_SALARY_KEY


def max_date_or_default(date_text: str) -> Column:
    """Aggregate: latest date of a text column, 1900-01-01 when there is none."""
    return F.coalesce(F.max(parse_date(date_text)), F.lit(EMPTY_WATERMARK_DATE).cast("date"))


def high_water_mark(staged: DataFrame, date_text: str) -> dt.date:
    """Latest date of the staged table, 1900-01-01 when it is empty.

    A one-row result, brought to the driver so that the delta's filters hold
    a literal, which reaches the source's scan. Reads the date column of the
    whole table; `sinks.staging.staged_mark` finds the mark of a staging
    table without that.
    """
    return staged.select(max_date_or_default(date_text)).first()[0]


def high_water_marks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per staged table: table_name, max_date (DATE)."""
    rows = [
        df.select(F.lit(name).alias("table_name"), max_date_or_default(date_text).alias("max_date"))
        for name, (df, date_text) in tables.items()
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def employees_delta(source: DataFrame, staged: DataFrame) -> DataFrame:
    """Source employees whose join date is strictly after the staged maximum.

    As in the original job, rows joining on the watermark day itself and
    updates to old rows are not picked up.
    """
    return employees_after(source, high_water_mark(staged, "join_date"))


def employees_after(source: DataFrame, mark: dt.date) -> DataFrame:
    """Source employees whose join date is strictly after `mark`."""
    return source.filter(
        (F.col("join_date") >= F.lit(f"{mark.year:04d}")) & (parse_date("join_date") > F.lit(mark))
    )


def timesheets_delta(source: DataFrame, staged: DataFrame) -> DataFrame:
    """Source timesheets dated on or after the first day of the staged maximum's month.

    Whole months are taken because salary per month depends on every
    timesheet of the month; rows older than that month are dropped.
    """
    return timesheets_from(source, high_water_mark(staged, "date").replace(day=1))


def timesheets_from(source: DataFrame, floor: dt.date) -> DataFrame:
    """Source timesheets dated on or after `floor`, the first day of a month."""
    cond = (F.col("date") >= F.lit(f"{floor.year:04d}")) & (parse_date("date") >= F.lit(floor))
    if {"year", "month"} <= set(source.columns):
        # a partitioned source: older months are not read
        cond = cond & (
            (F.col("year") > floor.year) | ((F.col("year") == floor.year) & (F.col("month") >= floor.month))
        )
    return source.filter(cond)


def current_period(spark: SparkSession, year: int | None = None, month: int | None = None) -> tuple[int, int]:
    """(year, month) of `current_date()` in the session's time zone; either part may be given."""
    today = spark.range(1).select(F.current_date()).first()[0]
    return year or today.year, month or today.month


def timesheets_in_period(timesheets: DataFrame, year: int, month: int) -> DataFrame:
    """Timesheets of one (year, month).

    The text range of the year reaches the Parquet scan; within it every date
    is parsed, so a malformed one stops the job as it does in a full load
    instead of falling out of a narrower text range. On a table partitioned
    by (year, month) the partition columns prune to the one month.
    """
    first = dt.date(year, month, 1)
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    d = parse_date("date")
    cond = (
        (F.col("date") >= F.lit(f"{year:04d}"))
        & (F.col("date") < F.lit(f"{year + 1:04d}"))
        & (d >= F.lit(first))
        & (d < F.lit(nxt))
    )
    if {"year", "month"} <= set(timesheets.columns):
        cond = cond & (F.col("year") == year) & (F.col("month") == month)
    return timesheets.filter(cond)


def _null_safe_key_cond(left: DataFrame, right: DataFrame, prefix: str) -> Column:
    cond = None
    for c in BRANCH_SALARY_KEY:
        term = left[c].eqNullSafe(right[f"{prefix}{c}"])
        cond = term if cond is None else cond & term
    return cond


def _keys(delta: DataFrame, prefix: str) -> DataFrame:
    return delta.select(*[F.col(c).alias(f"{prefix}{c}") for c in BRANCH_SALARY_KEY]).distinct()


def lookup_existing(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Existing result rows whose (branch_id, year, month) is in the delta (null-safe)."""
    keys = _keys(delta, "_k_")
    return existing.join(keys, _null_safe_key_cond(existing, keys, "_k_"), "left_semi")


def merge_branch_salary(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Upsert by (branch_id, year, month): delta rows replace equal keys, others stay."""
    keys = _keys(delta, "_k_")
    kept = existing.join(keys, _null_safe_key_cond(existing, keys, "_k_"), "left_anti")
    return kept.unionByName(delta.select(*existing.columns))
