"""The employee-month state of the incremental job, and CSV folders of several headers."""

import os

import pytest
from pyspark.sql import functions as F

import branchcost.plans.jobs as jobs
from branchcost.plans.cli import main
from branchcost.schemas import BRANCH_SALARY, EMPLOYEE_MONTH
from branchcost.sinks.staging import committed_mark
from branchcost.sources import load_employees, load_timesheets, read_partitioned, read_timesheets_csv
from branchcost.sources.readers import files_by_header
from conftest import SF_SMALL
from fixtures import golden_employees, golden_timesheets


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _paths(base):
    return [os.path.join(base, name) for name in ("employees", "timesheets", "result", "state")]


def _upto(ts, cut):
    return ts.filter(F.col("date") <= F.lit(cut)) if cut else ts


def test_full_load_from_state_after_several_increments(spark, tmp_table_dir):
    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    paths = _paths(tmp_table_dir)
    for cut in ("1996-03-10", "1999-06-17", None, None):
        jobs.run_incremental(spark, emp, _upto(ts, cut), *paths)
        if cut:
            assert _rows(jobs.full_from_state(spark, paths[3], emp)) == _rows(jobs.full_load(emp, _upto(ts, cut)))
    out = os.path.join(tmp_table_dir, "full")
    # no timesheet is read: the state alone, with the employees
    employees = golden_employees(spark)
    files = jobs.full_from_state(spark, paths[3], employees).inputFiles()
    assert files and all("/state/" in f for f in files)
    jobs.run_full_from_state(spark, emp, paths[3], out)
    assert _rows(read_partitioned(spark, out, BRANCH_SALARY)) == _rows(jobs.full_load(emp, ts))
    # one row per employee and month
    state = read_partitioned(spark, paths[3], EMPLOYEE_MONTH)
    assert state.count() == state.select("employee_id", "year", "month").distinct().count()


def test_state_takes_up_employees_that_changed(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    paths = _paths(tmp_table_dir)
    jobs.run_incremental(spark, emp, ts, *paths)
    moved = emp.withColumn("branch_id", F.lit(77))
    assert _rows(jobs.full_from_state(spark, paths[3], moved)) == _rows(jobs.full_load(moved, ts))


@pytest.mark.parametrize("stateless", [["2019-08-22"], ["2019-08-22", "2019-09-02"]])
def test_state_that_missed_loads_is_made_anew(spark, tmp_table_dir, stateless):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    paths = _paths(tmp_table_dir)
    if len(stateless) == 2:  # the state knows the first load only
        jobs.run_incremental(spark, emp, _upto(ts, stateless[0]), *paths)
    jobs.run_incremental(spark, emp, _upto(ts, stateless[-1]), *paths[:3])
    jobs.run_incremental(spark, emp, ts, *paths)
    assert _rows(jobs.full_from_state(spark, paths[3], emp)) == _rows(jobs.full_load(emp, ts))


@pytest.mark.parametrize("step", ["upsert_branch_salary", "reload_months", "replace_periods", "commit_mark"])
def test_state_after_a_failed_load(spark, tmp_table_dir, monkeypatch, step):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    paths = _paths(tmp_table_dir)
    jobs.run_incremental(spark, emp, _upto(ts, "2019-08-22"), *paths)
    mark = committed_mark(spark, paths[3])

    def dies(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs, step, dies)
    with pytest.raises(RuntimeError):
        jobs.run_incremental(spark, emp, ts, *paths)
    monkeypatch.undo()
    assert committed_mark(spark, paths[3]) == mark
    jobs.run_incremental(spark, emp, ts, *paths)
    assert _rows(jobs.full_from_state(spark, paths[3], emp)) == _rows(jobs.full_load(emp, ts))
    assert _rows(read_partitioned(spark, paths[2], BRANCH_SALARY)) == _rows(jobs.full_load(emp, ts))


def test_state_by_command_line_and_without_a_state(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    emp.write.parquet(f"{tmp_table_dir}/e")
    ts.write.parquet(f"{tmp_table_dir}/t")
    paths = _paths(tmp_table_dir)
    with pytest.raises(ValueError, match="no committed state"):
        jobs.full_from_state(spark, paths[3], emp)
    main(["incremental", "--employees", f"{tmp_table_dir}/e", "--timesheets", f"{tmp_table_dir}/t", "--result", paths[2],
          "--staging-employees", paths[0], "--staging-timesheets", paths[1], "--state", paths[3]])
    main(["from-state", "--employees", f"{tmp_table_dir}/e", "--state", paths[3], "--result", f"{tmp_table_dir}/r"])
    assert _rows(read_partitioned(spark, f"{tmp_table_dir}/r", BRANCH_SALARY)) == _rows(jobs.full_load(emp, ts))


def test_csv_files_are_read_by_their_own_headers(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "mixed csv")  # a blank in the name
    ts = golden_timesheets(spark)
    early, late = ts.filter("date < '2019-09-01'"), ts.filter("date >= '2019-09-01'")
    early.repartition(2).write.option("header", True).csv(path)
    turned = late.select(*reversed(late.columns)).withColumn("note", F.lit("a,b"))
    turned.coalesce(1).write.mode("append").option("header", True).option("compression", "gzip").csv(path)
    open(os.path.join(path, "part-empty.csv"), "w").close()
    assert len(files_by_header(spark, path)) == 2
    assert _rows(read_timesheets_csv(spark, path)) == _rows(ts)
    late.drop("checkin").coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(ValueError, match="checkin"):
        read_timesheets_csv(spark, path)
