"""Jobs and sinks: round trips, idempotence, incremental replay, guards."""

import os

from pyspark.sql import functions as F

from branchcost.plans.jobs import (
    full_load,
    run_current_period,
    run_full_load,
    run_incremental,
    run_salary_period,
    salary_by_period,
)
from branchcost.schemas import BRANCH_SALARY, EMPLOYEES, SALARY_PERIOD, TIMESHEETS
from branchcost.sinks.writers import append_rows, reload_months, upsert_branch_salary
from branchcost.sources import load_employees, load_timesheets, read_partitioned
from conftest import SF_SMALL
from fixtures import golden_employees, golden_timesheets


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _read_result(spark, path):
    return read_partitioned(spark, path, BRANCH_SALARY)


def test_full_load_round_trip_and_rerun(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    path = os.path.join(tmp_table_dir, "result")
    run_full_load(emp, ts, path)
    run_full_load(emp, ts, path)  # truncate + insert: still one copy
    assert _rows(_read_result(spark, path)) == _rows(full_load(emp, ts))


def test_salary_period_written_in_order(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    path = os.path.join(tmp_table_dir, "salary_period")
    run_salary_period(emp, ts, path)
    back = spark.read.schema(SALARY_PERIOD).parquet(path)
    assert _rows(back) == _rows(salary_by_period(emp, ts))


def _replay(spark, emp, ts, cuts, base):
    staging_emp = os.path.join(base, "staging_emp")
    staging_ts = os.path.join(base, "staging_ts")
    result = os.path.join(base, "result")
    statuses = []
    for cut in cuts:
        src = ts.filter(F.col("date") <= F.lit(cut)) if cut else ts
        statuses.append(run_incremental(spark, emp, src, staging_emp, staging_ts, result))
    return result, staging_emp, staging_ts, statuses


def test_incremental_replay_equals_full_load(spark, tmp_table_dir):
    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    result, staging_emp, staging_ts, statuses = _replay(
        spark, emp, ts, ["1996-03-10", "1999-06-17", "2000-01-31", None], tmp_table_dir
    )
    assert all(s.wrote for s in statuses)
    assert _rows(_read_result(spark, result)) == _rows(full_load(emp, ts))
    # staging holds every timesheet once although boundary months were reloaded
    staged = read_partitioned(spark, staging_ts, TIMESHEETS)
    assert staged.count() == ts.count()
    assert _rows(staged) == _rows(ts)
    assert spark.read.schema(EMPLOYEES).parquet(staging_emp).count() == emp.count()


def test_incremental_run_twice_equals_once(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    result, _, staging_ts, _ = _replay(spark, emp, ts, [None, None], tmp_table_dir)
    assert _rows(_read_result(spark, result)) == _rows(full_load(emp, ts))
    assert read_partitioned(spark, staging_ts, TIMESHEETS).count() == ts.count()


def test_incremental_drops_rows_older_than_watermark_month(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    sept = ts.filter(F.col("date") >= F.lit("2019-09-01"))
    result, _, _, _ = _replay(spark, emp, sept, [None], tmp_table_dir)
    # August arrives late, after September is staged: it is older than the watermark month
    run_incremental(
        spark, emp, ts, os.path.join(tmp_table_dir, "staging_emp"), os.path.join(tmp_table_dir, "staging_ts"), result
    )
    months = {(r.year, r.month) for r in _read_result(spark, result).collect()}
    assert months == {(2019, 9)}


def test_incremental_keeps_stale_branches(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    result = os.path.join(tmp_table_dir, "result")
    planted = spark.createDataFrame([(-1, 2019, 9, 1.0, 1, 1.0)], BRANCH_SALARY)
    run_full_load(emp, ts.filter(F.col("date") < F.lit("2019-09-01")), result)
    upsert_branch_salary(planted, result)
    _replay(spark, emp, ts, [None], tmp_table_dir)
    got = _rows(_read_result(spark, result))
    assert (-1, 2019, 9, 1.0, 1, 1.0) in got
    assert sorted(got, key=str) == sorted(_rows(full_load(emp, ts)) + [(-1, 2019, 9, 1.0, 1, 1.0)], key=str)


def test_current_period_replaces_month_and_drops_stale_branch(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    result = os.path.join(tmp_table_dir, "result")
    run_full_load(emp, ts, result)
    upsert_branch_salary(spark.createDataFrame([(-1, 2019, 9, 1.0, 1, 1.0)], BRANCH_SALARY), result)
    status = run_current_period(emp, ts, result, 2019, 9)
    assert status.wrote
    assert _rows(_read_result(spark, result)) == _rows(full_load(emp, ts))


def test_current_period_without_rows_writes_nothing(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    result = os.path.join(tmp_table_dir, "result")
    status = run_current_period(emp, ts, result, 2021, 1)
    assert not status.wrote and status.message == "no new data"
    assert not os.path.exists(result)


def test_incremental_with_nothing_new(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    empty = ts.filter(F.lit(False))
    _, _, _, statuses = _replay(spark, emp, empty, [None], tmp_table_dir)
    assert not statuses[0].wrote and statuses[0].message == "no new data"


def test_upsert_is_null_safe_on_branch(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "result")
    first = spark.createDataFrame([(None, 2019, 8, 2.0, None, None), (1, 2019, 8, 1.0, 5, 5.0)], BRANCH_SALARY)
    upsert_branch_salary(first, path)
    upsert_branch_salary(spark.createDataFrame([(None, 2019, 8, 3.0, None, None)], BRANCH_SALARY), path)
    assert _rows(_read_result(spark, path)) == sorted(
        [(None, 2019, 8, 3.0, None, None), (1, 2019, 8, 1.0, 5, 5.0)], key=str
    )


def test_month_reload_and_append(spark, tmp_table_dir):
    ts = golden_timesheets(spark)
    path = os.path.join(tmp_table_dir, "ts")
    reload_months(ts, path)
    reload_months(ts.filter(F.col("date") >= F.lit("2019-09-01")), path)
    assert _rows(read_partitioned(spark, path, TIMESHEETS)) == _rows(ts)
    emp = golden_employees(spark)
    epath = os.path.join(tmp_table_dir, "emp")
    append_rows(emp, epath)
    append_rows(emp, epath)
    assert spark.read.schema(EMPLOYEES).parquet(epath).count() == 2 * emp.count()


def test_csv_round_trip_restores_blanks(spark, tmp_table_dir):
    from branchcost.sources import read_employees_csv, read_timesheets_csv

    ts, emp = golden_timesheets(spark), golden_employees(spark)
    ts.write.option("header", True).csv(os.path.join(tmp_table_dir, "ts"))
    emp.write.option("header", True).csv(os.path.join(tmp_table_dir, "emp"))
    assert _rows(read_timesheets_csv(spark, os.path.join(tmp_table_dir, "ts"))) == _rows(ts)
    assert _rows(read_employees_csv(spark, os.path.join(tmp_table_dir, "emp"))) == _rows(emp)


def test_cli_runs_jobs_on_csv_input(spark, tmp_table_dir):
    from branchcost.plans.cli import main

    emp_csv = os.path.join(tmp_table_dir, "employees.csv")
    ts_csv = os.path.join(tmp_table_dir, "timesheets.csv")
    golden_employees(spark).write.option("header", True).csv(emp_csv)
    golden_timesheets(spark).write.option("header", True).csv(ts_csv)
    result = os.path.join(tmp_table_dir, "branch_salary")
    assert main(["full-load", "--employees", emp_csv, "--timesheets", ts_csv, "--result", result]) == 0
    assert _rows(_read_result(spark, result)) == _rows(full_load(golden_employees(spark), golden_timesheets(spark)))
    period = os.path.join(tmp_table_dir, "period")
    args = ["current-period", "--employees", emp_csv, "--timesheets", ts_csv, "--result", period]
    assert main(args + ["--year", "2019", "--month", "9"]) == 0
    assert {(r.year, r.month) for r in _read_result(spark, period).collect()} == {(2019, 9)}


import pytest  # noqa: E402


@pytest.mark.parametrize("failing_step", ["upsert_branch_salary", "reload_months"])
def test_incremental_rerun_after_failure(spark, tmp_table_dir, monkeypatch, failing_step):
    import branchcost.plans.jobs as jobs_module

    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    first = ts.filter(F.col("date") <= F.lit("1996-03-10"))
    _replay(spark, emp, first, [None], tmp_table_dir)

    def dies(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs_module, failing_step, dies)
    try:
        _replay(spark, emp, ts, [None], tmp_table_dir)  # delta spans many months; dies at the last step
    except RuntimeError:
        pass
    monkeypatch.undo()
    result, _, staging_ts, _ = _replay(spark, emp, ts, [None], tmp_table_dir)
    assert _rows(_read_result(spark, result)) == _rows(full_load(emp, ts))
    assert read_partitioned(spark, staging_ts, TIMESHEETS).count() == ts.count()


def test_jobs_remove_their_snapshots(spark, tmp_table_dir):
    from branchcost.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).replace("file:", "").rstrip("/") + "/branchcost-snapshots"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    _replay(spark, golden_employees(spark), golden_timesheets(spark), ["2019-08-22", None], tmp_table_dir)
    after = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert after - before == set()


def test_upsert_merges_the_null_month_partition(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "result")
    first = spark.createDataFrame(
        [(1, None, None, 8.0, 5, 1.0), (2, None, None, 8.0, 6, 1.0), (1, 2019, 8, 1.0, 5, 5.0)], BRANCH_SALARY
    )
    upsert_branch_salary(first, path)
    upsert_branch_salary(spark.createDataFrame([(1, None, None, 16.0, 5, 2.0)], BRANCH_SALARY), path)
    assert _rows(_read_result(spark, path)) == sorted(
        [(1, None, None, 16.0, 5, 2.0), (2, None, None, 8.0, 6, 1.0), (1, 2019, 8, 1.0, 5, 5.0)], key=str
    )


def test_cli_incremental_and_salary_period(spark, tmp_table_dir, capsys):
    from branchcost.plans.cli import main

    emp_csv = os.path.join(tmp_table_dir, "employees.csv")
    ts_csv = os.path.join(tmp_table_dir, "timesheets.csv")
    golden_employees(spark).write.option("header", True).csv(emp_csv)
    golden_timesheets(spark).write.option("header", True).csv(ts_csv)
    args = [
        "incremental", "--employees", emp_csv, "--timesheets", ts_csv,
        "--result", os.path.join(tmp_table_dir, "result"),
        "--staging-employees", os.path.join(tmp_table_dir, "se"),
        "--staging-timesheets", os.path.join(tmp_table_dir, "st"),
    ]
    assert main(args) == 0 and main(args) == 0  # a second run with nothing new changes nothing
    expected = _rows(full_load(golden_employees(spark), golden_timesheets(spark)))
    assert _rows(_read_result(spark, os.path.join(tmp_table_dir, "result"))) == expected
    period = os.path.join(tmp_table_dir, "salary_period")
    assert main(["salary-period", "--employees", emp_csv, "--timesheets", ts_csv, "--result", period]) == 0
    got = {tuple(r) for r in spark.read.schema(SALARY_PERIOD).parquet(period).collect()}
    assert got == {tuple(r) for r in salary_by_period(golden_employees(spark), golden_timesheets(spark)).collect()}


def test_full_load_replaces_the_whole_table(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    path = os.path.join(tmp_table_dir, "result")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # a user's session setting
    try:
        run_full_load(emp, ts, path)
        august = ts.filter(F.col("date") < F.lit("2019-09-01"))
        run_full_load(emp, august, path)  # September is no longer in the input: it must go
        assert _rows(_read_result(spark, path)) == _rows(full_load(emp, august))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")


def test_monthly_increments_equal_full_load(spark, tmp_table_dir):
    """One incremental run per month-end, as a scheduled job would, over one year."""
    emp = load_employees(spark, SF_SMALL)
    year = load_timesheets(spark, SF_SMALL).filter(F.col("date").startswith("1998-"))
    cuts = [f"1998-{m:02d}-31" for m in range(1, 13)]
    result, _, staging_ts, statuses = _replay(spark, emp, year, cuts, tmp_table_dir)
    assert all(s.wrote for s in statuses)
    assert _rows(_read_result(spark, result)) == _rows(full_load(emp, year))
    assert read_partitioned(spark, staging_ts, TIMESHEETS).count() == year.count()
