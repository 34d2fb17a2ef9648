"""Timesheet cleansing and hours worked.

`timesheet_hours` is the engine's form: one pass over the timesheets with
a CASE expression. `timesheet_cleansing` / `timesheet_bad` /
`timesheet_good` give the row sets of the original SQL's stages, and
`timesheet_hours_literal` rebuilds hours from them (UNION ALL of bad rows
at 8 h and good rows at their span) to check the one-pass form against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchcost.functions.columns import span_seconds_sql
from branchcost.functions import (
    DEFAULT_WORK_SECONDS,
    is_blank,
    month_of,
    parse_clock,
    parse_date,
    seconds_to_hours,
    work_seconds,
    year_of,
)

CLEANSED_COLUMNS = ["timesheet_id", "employee_id", "date", "checkin", "checkout"]


def timesheet_hours(timesheets: DataFrame, both_blank_twice: bool = False) -> DataFrame:
    """Seconds and hours worked per timesheet row, with its year and month.

    Columns: timesheet_id, employee_id, year, month, work_seconds (BIGINT),
    work_hour (DOUBLE). Blank or non-positive spans count 8 hours; with
    `both_blank_twice` a row whose both times are blank counts 16, which
    is what the original three-way UNION ALL computes, here in one pass.
    """
    parsed = timesheets.select(
        "timesheet_id",
        "employee_id",
        parse_date("date").alias("day"),
        parse_clock("date", "checkin").alias("checkin"),
        parse_clock("date", "checkout").alias("checkout"),
        (is_blank("checkin") & is_blank("checkout")).alias("both_blank"),
    )
    # a text is parsed once, in the projection above: with the parsers inlined wherever a time is
    # used, the generated method outgrows what the JVM compiles
    seconds = work_seconds("checkin", "checkout")
    if both_blank_twice:
        seconds = F.when(F.col("both_blank"), F.lit(2 * DEFAULT_WORK_SECONDS).cast("long")).otherwise(seconds)
    return parsed.select(
        "timesheet_id",
        "employee_id",
        year_of("day").alias("year"),
        month_of("day").alias("month"),
        seconds.alias("work_seconds"),
    ).withColumn("work_hour", seconds_to_hours("work_seconds"))


def timesheet_cleansing(timesheets: DataFrame) -> DataFrame:
    """Typed timesheets with the rows of the original three-way UNION ALL.

    Complete rows, rows without checkout (checkout null) and rows without
    checkin (checkin null). A row with both times blank belongs to both of
    the last two branches and so gives two rows, its blank half read as
    midnight of its date. Computed in one scan: each input row yields an
    array of one or two (checkin, checkout) pairs that is exploded.
    """
    present_in = ~is_blank("checkin")
    present_out = ~is_blank("checkout")
    cin = parse_clock("date", "checkin")
    cout = parse_clock("date", "checkout")
    midnight = parse_date("date").cast("timestamp_ntz")
    null_ts = F.lit(None).cast("timestamp_ntz")
    first = F.when(present_in & present_out, F.struct(cin.alias("i"), cout.alias("o"))).when(
        ~present_out, F.struct(F.coalesce(cin, midnight).alias("i"), null_ts.alias("o"))
    )
    second = F.when(~present_in, F.struct(null_ts.alias("i"), F.coalesce(cout, midnight).alias("o")))
    return timesheets.select(
        "timesheet_id",
        "employee_id",
        parse_date("date").alias("date"),
        F.explode(F.array_compact(F.array(first, second))).alias("_t"),
    ).select(
        "timesheet_id",
        "employee_id",
        "date",
        F.col("_t.i").alias("checkin"),
        F.col("_t.o").alias("checkout"),
    )


def timesheet_bad(cleansed: DataFrame) -> DataFrame:
    """Rows that count 8 hours: a time missing, or checkout not after checkin."""
    cin, cout = F.col("checkin"), F.col("checkout")
    return cleansed.filter(cin.isNull() | cout.isNull() | (cout <= cin))


def timesheet_good(cleansed: DataFrame) -> DataFrame:
    """Rows whose hours are checkout minus checkin."""
    return cleansed.filter(F.col("checkout") > F.col("checkin"))


def timesheet_hours_literal(timesheets: DataFrame) -> DataFrame:
    """Hours per row from the UNION ALL of bad (8 h) and good rows.

    Same columns as `timesheet_hours`; both-blank rows appear twice.
    """
    cleansed = timesheet_cleansing(timesheets)
    bad = timesheet_bad(cleansed).withColumn("work_seconds", F.lit(DEFAULT_WORK_SECONDS).cast("long"))
    good = timesheet_good(cleansed).withColumn("work_seconds", F.expr(span_seconds_sql("checkin", "checkout")))
    return (
        bad.unionByName(good)
        .select(
            "timesheet_id",
            "employee_id",
            year_of("date").alias("year"),
            month_of("date").alias("month"),
            "work_seconds",
        )
        .withColumn("work_hour", seconds_to_hours("work_seconds"))
    )
