"""Staging tables: batches, marks, partition metadata, loads that die while files are committed."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

import branchcost.plans.jobs as jobs
from branchcost.plans.jobs import full_load, run_current_period, run_incremental
from branchcost.schemas import BRANCH_SALARY, EMPLOYEES, STAGED_TIMESHEETS, TIMESHEETS
from branchcost.sinks import staging
from branchcost.sinks.staging import EMPTY_MARK, append_batch, committed_mark, read_staged, staged_mark, staged_months
from branchcost.sinks.writers import append_rows, reload_months
from branchcost.sources import load_employees, load_timesheets, read_partitioned
from conftest import SF_SMALL
from fixtures import golden_employees, golden_timesheets


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _paths(base):
    return [os.path.join(base, name) for name in ("se", "st", "result")]


def test_batches_commit_their_latest_date(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "se")
    emp = load_employees(spark, SF_SMALL)
    early = emp.where("join_date <= '1995-06-17'")
    assert staged_mark(spark, path, EMPLOYEES, "join_date") == EMPTY_MARK
    assert append_batch(early, path, EMPTY_MARK) == early.count()
    mark = staged_mark(spark, path, EMPLOYEES, "join_date")
    assert mark == dt.date.fromisoformat(early.agg(F.max("join_date")).first()[0])
    assert append_batch(emp.where("join_date > '1995-06-17'"), path, mark) > 0
    assert _rows(read_staged(spark, path, EMPLOYEES)) == _rows(emp)
    assert os.listdir(os.path.join(path, "_marks")).count(committed_mark(spark, path).isoformat()) == 1
    assert append_batch(emp.limit(0), path, committed_mark(spark, path)) == 0
    assert append_batch(spark.createDataFrame([], EMPLOYEES), path, committed_mark(spark, path)) == 0
    assert read_staged(spark, path, EMPLOYEES).count() == emp.count()


def test_half_committed_append_is_taken_again(spark, tmp_table_dir):
    """Some files of an append are there, its job is not: the next run must still take all rows."""
    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    first = emp.where("join_date <= '1995-06-17'")
    paths = _paths(tmp_table_dir)
    run_incremental(spark, first, ts.where("date <= '1996-03-10'"), *paths)
    mark = committed_mark(spark, paths[0])
    rest = emp.where(F.col("join_date") > mark.isoformat())
    # the latest row and a few others have arrived, most have not
    part = rest.orderBy(F.desc("join_date")).limit(3)
    part.write.parquet(os.path.join(paths[0], f"batch={mark.isoformat()}"))
    assert read_staged(spark, paths[0], EMPLOYEES).count() == first.count()  # readers see committed batches only
    run_incremental(spark, emp, ts, *paths)
    assert _rows(read_staged(spark, paths[0], EMPLOYEES)) == _rows(emp)
    clean = os.path.join(tmp_table_dir, "clean")
    run_incremental(spark, first, ts.where("date <= '1996-03-10'"), *_paths(clean))
    run_incremental(spark, emp, ts, *_paths(clean))
    result = lambda base: _rows(read_partitioned(spark, _paths(base)[2], BRANCH_SALARY))
    assert result(tmp_table_dir) == result(clean)


def test_half_replaced_months_are_taken_again(spark, tmp_table_dir, monkeypatch):
    """A job dies after the last month of its delta is in staging, but not those before it."""
    emp, ts = golden_employees(spark), load_timesheets(spark, SF_SMALL).where("date >= '1998-01-01'")
    paths = _paths(tmp_table_dir)
    run_incremental(spark, emp, ts.where("date < '1998-04-01'"), *paths)

    def dies(delta, path, **kwargs):
        reload_months(delta.where("date >= '1998-11-01'"), path, materialize=False)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs, "reload_months", dies)
    with pytest.raises(RuntimeError):
        run_incremental(spark, emp, ts, *paths)
    monkeypatch.undo()
    run_incremental(spark, emp, ts, *paths)
    assert _rows(read_partitioned(spark, paths[1], TIMESHEETS)) == _rows(ts)
    assert _rows(read_partitioned(spark, paths[2], BRANCH_SALARY)) == _rows(full_load(emp, ts))


def test_mark_and_months_open_no_older_file(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "st")
    ts = load_timesheets(spark, SF_SMALL)
    reload_months(ts, path, materialize=False)
    months = sorted({(int(d[:4]), int(d[5:7])) for (d,) in ts.select("date").distinct().collect()})
    latest = ts.agg(F.max("date")).first()[0]
    for f in glob.glob(f"{path}/year=*/month=*/*.parquet"):
        if f"year={int(latest[:4])}/month={int(latest[5:7])}/" not in f:
            with open(f, "wb") as out:  # would fail to be read
                out.write(b"x")
    assert staged_months(spark, path) == months
    assert [tuple(r) for r in staging.staged_period_list(spark, path).collect()] == months
    assert staged_mark(spark, path, STAGED_TIMESHEETS, "date") == dt.date.fromisoformat(latest)
    staging.commit_mark(spark, path, dt.date.fromisoformat(latest))
    shutil.copytree(path, os.path.join(tmp_table_dir, "copy"), ignore=lambda d, names: [n for n in names if "parquet" in n])
    # with a mark no data file is needed at all
    assert staged_mark(spark, os.path.join(tmp_table_dir, "copy"), STAGED_TIMESHEETS, "date") == dt.date.fromisoformat(latest)
    empty = os.path.join(tmp_table_dir, "none")
    assert staged_months(spark, empty) == [] and staging.staged_period_list(spark, empty).columns == ["year", "month"]


def test_last_month_may_be_empty_and_dates_null(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "st")
    ts = golden_timesheets(spark).unionByName(spark.createDataFrame([(9000, 1, "", "", "")], TIMESHEETS))
    reload_months(ts, path, materialize=False)
    os.makedirs(f"{path}/year=2031/month=1")
    assert (2031, 1) in staged_months(spark, path)
    assert staged_mark(spark, path, STAGED_TIMESHEETS, "date") == dt.date.fromisoformat(ts.agg(F.max("date")).first()[0])


def test_files_outside_batches_are_refused(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "se")
    append_rows(golden_employees(spark), path)
    with pytest.raises(ValueError, match="outside batches"):
        append_batch(golden_employees(spark), path, EMPTY_MARK)


def test_catalog_tables_carry_their_mark(spark, tmp_table_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS staged")
    try:
        emp, ts = golden_employees(spark), golden_timesheets(spark)
        names = ["table:staged.se", "table:staged.st", "table:staged.result"]
        run_incremental(spark, emp, ts.where("date < '2019-09-01'"), *names)
        mark = committed_mark(spark, names[0])
        assert mark == staged_mark(spark, names[0], EMPLOYEES, "join_date") > EMPTY_MARK
        # a half-written batch of the same mark
        with staging._session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            emp.limit(2).withColumn("batch", F.lit(mark.isoformat())).write.insertInto("staged.se")
        assert read_staged(spark, names[0], EMPLOYEES).count() == emp.count()
        run_incremental(spark, emp, ts, *names)
        assert _rows(spark.table("staged.se").drop("batch")) == _rows(emp)
        assert staged_months(spark, names[1]) == [(2019, 8), (2019, 9)]
        assert _rows(read_partitioned(spark, names[2], BRANCH_SALARY)) == _rows(full_load(emp, ts))
    finally:
        spark.sql("DROP DATABASE staged CASCADE")


def _counted(spark, df):
    """`df`, and a counter of the rows that are read of it."""
    seen = spark.sparkContext.accumulator(0)
    name = "employee_id" if "employee_id" in df.columns else "employe_id"

    @F.udf(df.schema[name].dataType)
    def count(value):
        seen.add(1)
        return value

    return df.withColumn(name, count.asNondeterministic()(F.col(name))), seen


def test_jobs_read_each_source_once(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    paths = _paths(tmp_table_dir)
    (emp_seen, n_emp), (ts_seen, n_ts) = _counted(spark, emp), _counted(spark, ts)
    run_incremental(spark, emp_seen, ts_seen, *paths)
    assert (n_emp.value, n_ts.value) == (emp.count(), ts.count())
    (emp_seen, n_emp), (ts_seen, n_ts) = _counted(spark, emp), _counted(spark, ts)
    run_current_period(emp_seen, ts_seen, paths[2], 2019, 9)
    assert (n_emp.value, n_ts.value) == (emp.count(), ts.count())
    assert _rows(read_partitioned(spark, paths[2], BRANCH_SALARY)) == _rows(full_load(emp, ts))
