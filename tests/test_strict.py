"""Strict dates and clock times, CSV headers, catalog tables, period defaults, shared folder."""

import os

import pytest
from pyspark.sql import functions as F

from branchcost.operators import current_period, dedup_employees, duplicate_ids, period_list
from branchcost.plans import jobs
from branchcost.plans.cli import main
from branchcost.schemas import BRANCH_SALARY, EMPLOYEES, SALARY_PERIOD, STAGED_TIMESHEETS, TIMESHEETS
from branchcost.session import ensure_checkpoint_dir
from branchcost.sinks.writers import write_ordered
from branchcost.sources import read_employees_csv, read_partitioned, read_timesheets_csv
from fixtures import golden_employees, golden_timesheets

BAD_DATES = ["2019", "2019-08", "2019-08-21 junk", "2019-08-21T99", "2019-8-5", "2019-08-21\n", "2019-13-01"]
BAD_CLOCKS = ["08", "08:00", "08:00:00 America/New_York", "08:00:00Z", "25:00:00"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _with(spark, date="2019-08-21", checkin="08:00:00"):
    return golden_timesheets(spark).unionByName(
        spark.createDataFrame([(200, 1, date, checkin, "17:00:00")], TIMESHEETS)
    )


def _jobs(spark, emp, ts, base):
    path = lambda n: os.path.join(base, n)
    return {
        "full": lambda: jobs.run_full_load(emp, ts, path("full")),
        "incremental": lambda: jobs.run_incremental(spark, emp, ts, path("se"), path("st"), path("inc")),
        "current": lambda: jobs.run_current_period(emp, ts, path("cur"), 2019, 8),
    }


@pytest.mark.parametrize("date", BAD_DATES)
def test_malformed_dates_stop_every_job(spark, tmp_table_dir, date):
    emp, ts = golden_employees(spark), _with(spark, date=date)
    runs = _jobs(spark, emp, ts, tmp_table_dir)
    runs["period"] = lambda: jobs.run_salary_period(emp, ts, os.path.join(tmp_table_dir, "p"))
    for name, run in runs.items():
        with pytest.raises(Exception, match="malformed date|CAST_INVALID_INPUT"):
            run()
            pytest.fail(name)


@pytest.mark.parametrize("clock", BAD_CLOCKS)
def test_malformed_times_stop_every_job(spark, tmp_table_dir, clock):
    emp, ts = golden_employees(spark), _with(spark, checkin=clock)
    for name, run in _jobs(spark, emp, ts, tmp_table_dir).items():
        with pytest.raises(Exception, match="malformed date or time|CAST_INVALID_INPUT"):
            run()
            pytest.fail(name)


def test_csv_columns_go_by_name(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    for df, read in ((emp, read_employees_csv), (ts, read_timesheets_csv)):
        path = os.path.join(tmp_table_dir, df.columns[0])
        mixed = df.select(*reversed(df.columns)).withColumn("note", F.lit("x")).coalesce(1)
        mixed.write.option("header", True).csv(path)
        assert _rows(read(spark, path)) == _rows(df)
        short = os.path.join(tmp_table_dir, "short-" + df.columns[0])
        df.drop(df.columns[1]).coalesce(1).write.option("header", True).csv(short)
        with pytest.raises(ValueError, match=df.columns[1]):
            read(spark, short)


def test_jobs_read_and_write_catalog_tables(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    spark.sql(f"CREATE DATABASE payroll LOCATION '{tmp_table_dir}/payroll.db'")
    try:
        emp.write.saveAsTable("payroll.emp")
        ts.write.saveAsTable("payroll.ts")
        io = ["--employees", "table:payroll.emp", "--timesheets", "table:payroll.ts"]
        main(["full-load", *io, "--result", "table:payroll.full"])
        want = _rows(jobs.full_load(emp, ts))
        assert _rows(spark.table("payroll.full").select(*BRANCH_SALARY.fieldNames())) == want
        staging = ["--staging-employees", "table:payroll.se", "--staging-timesheets", "table:payroll.st"]
        for _ in range(2):
            main(["incremental", *io, "--result", "table:payroll.inc", *staging])
            assert _rows(read_partitioned(spark, "table:payroll.inc", BRANCH_SALARY)) == want
        assert read_partitioned(spark, "table:payroll.st", STAGED_TIMESHEETS).count() == 12
        main(["current-period", *io, "--result", "table:payroll.full", "--year", "2019", "--month", "9"])
        assert _rows(read_partitioned(spark, "table:payroll.full", BRANCH_SALARY)) == want
        main(["salary-period", *io, "--result", "table:payroll.sp"])
        assert _rows(spark.table("payroll.sp")) == _rows(jobs.salary_by_period(emp, ts))
    finally:
        spark.sql("DROP DATABASE payroll CASCADE")


def test_year_and_month_default_each_alone(spark):
    today = spark.range(1).select(F.current_date()).first()[0]
    assert current_period(spark) == (today.year, today.month)
    assert current_period(spark, year=2019) == (2019, today.month)
    assert current_period(spark, month=8) == (today.year, 8)
    assert current_period(spark, 2019, 8) == (2019, 8)


def test_seed_shape_reduces_to_one_row_per_id(spark):
    rows = [(218000 + i, i % 5, 4_000_000 + 1000 * i, "2019-01-01", "") for i in range(176)]
    rows.append((218078, 3, 13_000_000, "2019-01-01", ""))  # one id twice; the higher salary wins
    seed = spark.createDataFrame(rows, EMPLOYEES)
    once = _rows(dedup_employees(seed))
    assert len(once) == 176
    assert [r[2] for r in once if r[0] == 218078] == [13_000_000]
    assert [tuple(r) for r in duplicate_ids(seed).collect()] == [(218078, 2)]
    assert _rows(dedup_employees(seed.unionByName(seed))) == once


def test_period_list_and_written_result_are_ordered(spark, tmp_table_dir):
    ts = golden_timesheets(spark).unionByName(spark.createDataFrame([(1, 1, "2018-12-31", "", "")], TIMESHEETS))
    assert [tuple(r) for r in period_list(ts, ordered=True).collect()] == [(2018, 12), (2019, 8), (2019, 9)]
    path = os.path.join(tmp_table_dir, "ordered")
    write_ordered(jobs.salary_by_period(golden_employees(spark), ts), path, "year", "month", "branch_id")
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    got = [tuple(r) for f in files for r in spark.read.schema(SALARY_PERIOD).parquet(os.path.join(path, f)).collect()]
    assert got == sorted(got, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0))


def test_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
