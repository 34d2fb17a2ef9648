"""Writers for staging and result tables.

A target is a path, or a catalog table written ``table:name``.

Result and timesheet staging tables are partitioned by (year, month), so
that a job that recomputes some months rewrites only those partitions
(dynamic partition overwrite) and a period filter prunes partitions on
read. A writer that replaces data it also reads first materialises its
input as a Parquet table in the cluster's checkpoint folder (`snapshot`),
so the write never reads files it is deleting and a lost executor is
recomputed from those files, not from the half-replaced table.

Partitioned writes carry a REBALANCE hint on (year, month): AQE then
packs small months into one file each and splits a month that holds a
large share of the rows into several tasks, instead of one task per
month or one file per task and month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from branchcost.functions import parse_date
from branchcost.operators import merge_branch_salary
from branchcost.schemas import BRANCH_SALARY, PERIOD_KEY
from branchcost.session import snapshot
from branchcost.sources import read_or_empty, table_name, with_period_columns


def _save(writer: DataFrameWriter, target: str, overwrite: str | None = None) -> None:
    """Write to a path, or create a catalog table when the target is ``table:name``.

    `overwrite` is the partition overwrite mode for a path. A table is made
    anew; the option would stay with it as a table property.
    """
    if table_name(target):
        writer.format("parquet").saveAsTable(table_name(target))
    else:
        (writer.option("partitionOverwriteMode", overwrite) if overwrite else writer).parquet(target)


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for one write: `insertInto` does not take it as an option."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _by(df: DataFrame, *columns: str) -> DataFrameWriter:
    return df.hint("rebalance", *columns).write.partitionBy(*columns)


def replace_partitions(df: DataFrame, target: str, *columns: str) -> None:
    """Replace the partitions by `columns` present in `df`; others stay. `df` must not read `target`."""
    name = table_name(target)
    if name and df.sparkSession.catalog.tableExists(name):
        rows = df.select(*df.sparkSession.table(name).columns).hint("rebalance", *columns)
        with _session_setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.write.mode("overwrite").insertInto(name)
    else:
        _save(_by(df, *columns).mode("overwrite"), target, overwrite="dynamic")


def overwrite_by(df: DataFrame, target: str, *columns: str) -> None:
    """Replace the whole table, partitioned by `columns` (static overwrite: marks and absent partitions go too)."""
    _save(_by(df, *columns).mode("overwrite"), target, overwrite="static")


def _replace_months(df: DataFrame, target: str) -> None:
    """Replace the (year, month) partitions present in `df`; others stay."""
    replace_partitions(df, target, *PERIOD_KEY)


def write_full_overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole table (truncate + insert). `df` must not read `path`."""
    _save(df.write.mode("overwrite"), path)


def write_partitioned_overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole table, partitioned by (year, month) (truncate + insert).

    Static overwrite: months absent from `df` disappear too.
    """
    overwrite_by(df, path, *PERIOD_KEY)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a table. Not safe to repeat; the jobs stage with `staging.append_batch`."""
    _save(df.write.mode("append"), path)


def reload_months(df: DataFrame, path: str, date_col: str = "date", materialize: bool = True) -> dt.date | None:
    """Replace the (year, month) partitions present in `df`; other months stay. Returns the latest date written.

    Re-inserting a boundary month therefore leaves no duplicates. Pass
    `materialize=False` only when `df` is already checkpointed or does not
    read `path`.
    """
    staged = with_period_columns(df, date_col)
    seen = Observation("months")
    latest = F.max(parse_date(date_col)).alias("latest")
    if not materialize:
        _replace_months(staged.observe(seen, latest), path)
        return seen.get["latest"]
    with snapshot(staged, "months") as frozen:
        _replace_months(frozen.observe(seen, latest), path)
    return seen.get["latest"]


def replace_periods(result: DataFrame, path: str) -> None:
    """Replace every (year, month) partition present in `result` by its rows.

    Branches of those months that are absent from `result` disappear.
    """
    _replace_months(result, path)


def upsert_branch_salary(delta: DataFrame, path: str) -> None:
    """Upsert by (branch_id, year, month), null-safe.

    Only the months touched by `delta` are read back (partition pruning
    through the semi-join on year, month), merged with it, materialised and
    written with dynamic partition overwrite. Rows of branches absent from
    the delta stay.
    """
    spark = delta.sparkSession
    delta = delta.select(*BRANCH_SALARY.fieldNames())
    existing = read_or_empty(spark, path, BRANCH_SALARY)
    months = delta.select(*PERIOD_KEY).distinct()
    # equality semi-join: planned as dynamic partition pruning of the scan
    touched = existing.join(months, PERIOD_KEY, "left_semi")
    # rows of a null (year, month) partition (timesheets without a date) are
    # matched null-safely; the isNull filter prunes the scan to that partition
    null_month = F.col("year").isNull() | F.col("month").isNull()
    nm = months.filter(null_month).select(*[F.col(c).alias(f"_n_{c}") for c in PERIOD_KEY])
    null_rows = existing.filter(null_month)
    null_rows = null_rows.join(
        nm,
        null_rows["year"].eqNullSafe(nm["_n_year"]) & null_rows["month"].eqNullSafe(nm["_n_month"]),
        "left_semi",
    )
    touched = touched.unionByName(null_rows)
    with snapshot(merge_branch_salary(touched, delta), "merged") as merged:
        _replace_months(merged, path)


def write_ordered(df: DataFrame, path: str, *cols: str) -> None:
    """Overwrite with rows sorted by `cols` (nulls last) across output files."""
    _save(df.orderBy(*[F.col(c).asc_nulls_last() for c in cols]).write.mode("overwrite"), path)
