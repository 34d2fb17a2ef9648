"""The kept table of current employees, and first loads that die before their mark."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import branchcost.plans.jobs as jobs
from branchcost.operators import dedup_employees, employees_after
from branchcost.plans.cli import main
from branchcost.schemas import BRANCH_SALARY, EMPLOYEES, TIMESHEETS
from branchcost.sinks import current as kept
from branchcost.sinks.current import current_employees, keep_current
from branchcost.sinks.staging import EMPTY_MARK, append_batch, committed_mark, read_staged, staged_mark
from branchcost.sources import load_employees, load_timesheets, read_partitioned
from conftest import SF_SMALL
from fixtures import golden_employees, golden_timesheets


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _stage(spark, emp, path, until="9999-12-31"):
    mark = staged_mark(spark, path, EMPLOYEES, "join_date")
    append_batch(employees_after(emp.where(F.col("join_date") <= until), mark), path, mark)


def _employees(spark):
    """Repeated ids whose better, equal and worse rows come in later loads, a null id, a hot id."""
    rows = [(i, i % 3, 1000 + i, f"2019-{1 + i % 9:02d}-01", "") for i in range(40)]
    rows += [(i, 7, 900 + 10 * i, "2019-10-01", "2020-01-01") for i in range(0, 40, 4)]
    rows += [(5, i, 1005, "2019-11-01", "") for i in range(30)]
    rows += [(None, 1, None, "2019-10-02", None), (None, 2, 5, "2019-11-02", "")]
    return spark.createDataFrame(rows, EMPLOYEES)


def test_merged_loads_equal_the_deduplication(spark, tmp_table_dir):
    staging, target = f"{tmp_table_dir}/se", f"{tmp_table_dir}/current"
    for emp in (_employees(spark),):
        for until in ("2019-05-15", "2019-10-01", "2019-10-01", "2019-10-15", "9999"):
            _stage(spark, emp, staging, until)
            keep_current(spark, target, staging, buckets=8)
            assert committed_mark(spark, target) == committed_mark(spark, staging)
            assert _rows(current_employees(spark, target)) == _rows(dedup_employees(emp.where(F.col("join_date") <= until)))


def test_only_touched_buckets_are_written_and_reading_has_no_shuffle(spark, tmp_table_dir):
    staging, target = f"{tmp_table_dir}/se", f"{tmp_table_dir}/current"
    emp = golden_employees(spark).limit(0).unionByName(_employees(spark).where("join_date < '2019-10-01'"))
    _stage(spark, emp, staging)
    keep_current(spark, target, staging, buckets=16)
    before = set(glob.glob(f"{target}/bucket=*/*.parquet"))
    one = spark.createDataFrame([(3, 9, 99999, "2021-01-01", "")], EMPLOYEES)
    _stage(spark, one, staging)
    keep_current(spark, target, staging, buckets=16)
    changed = {os.path.dirname(f) for f in before ^ set(glob.glob(f"{target}/bucket=*/*.parquet"))}
    assert len(changed) == 1 and len({os.path.dirname(f) for f in before}) > 8
    assert _rows(current_employees(spark, target)) == _rows(dedup_employees(emp.unionByName(one)))
    plan = current_employees(spark, target)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_a_merge_that_dies_is_made_anew(spark, tmp_table_dir, monkeypatch):
    staging, target = f"{tmp_table_dir}/se", f"{tmp_table_dir}/current"
    emp = _employees(spark)
    _stage(spark, emp, staging, "2019-09-30")
    keep_current(spark, target, staging, buckets=4)
    _stage(spark, emp, staging)
    write = kept.replace_partitions

    def half(rows, path, *columns):  # some buckets lose rows, then the job dies
        write(rows.where("employe_id > 20"), path, *columns)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(kept, "replace_partitions", half)
    with pytest.raises(RuntimeError):
        keep_current(spark, target, staging, buckets=4)
    with pytest.raises(ValueError, match="no committed employees"):
        current_employees(spark, target)
    monkeypatch.undo()
    keep_current(spark, target, staging, buckets=4)
    assert _rows(current_employees(spark, target)) == _rows(dedup_employees(emp))
    # another number of buckets: made anew, without rows of the old ones
    keep_current(spark, target, staging, buckets=6)
    assert _rows(current_employees(spark, target)) == _rows(dedup_employees(emp))


def test_incremental_job_with_current_employees(spark, tmp_table_dir):
    """Same results as without; loads without the table are taken up; catalog tables; nothing staged."""
    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    plain = [f"{tmp_table_dir}/plain-{n}" for n in ("se", "st", "result")]
    with_it = [f"{tmp_table_dir}/kept-{n}" for n in ("se", "st", "result")]
    target = f"{tmp_table_dir}/current"
    for k, cut in enumerate(("1996-03-10", "1997-06-17", "9999")):
        part_e, part_t = emp.where(F.col("join_date") <= cut), ts.where(F.col("date") <= cut)
        jobs.run_incremental(spark, part_e, part_t, *plain)
        jobs.run_incremental(spark, part_e, part_t, *with_it, current_path=None if k == 1 else target)
    assert _rows(current_employees(spark, target)) == _rows(dedup_employees(emp))
    found, expected = (_rows(read_partitioned(spark, p[2], BRANCH_SALARY)) for p in (with_it, plain))
    assert found == expected and found

    none = [f"{tmp_table_dir}/none-{n}" for n in ("se", "st", "result")]
    status = jobs.run_incremental(spark, emp.limit(0), ts.limit(0), *none, current_path=f"{tmp_table_dir}/none")
    assert not status.wrote and current_employees(spark, f"{tmp_table_dir}/none").count() == 0


def test_catalog_table_and_command_line(spark, tmp_table_dir):
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    staging, target = f"{tmp_table_dir}/se", "table:current_employees_kept"
    spark.sql("DROP TABLE IF EXISTS current_employees_kept")
    for until in ("2019-05-15", "2019-10-15", "9999"):
        _stage(spark, _employees(spark), staging, until)
        keep_current(spark, target, staging, buckets=4)
    assert _rows(current_employees(spark, target)) == _rows(dedup_employees(_employees(spark)))
    spark.sql("DROP TABLE current_employees_kept")
    emp.write.parquet(f"{tmp_table_dir}/e")
    ts.write.parquet(f"{tmp_table_dir}/t")
    main(["incremental", "--employees", f"{tmp_table_dir}/e", "--timesheets", f"{tmp_table_dir}/t", "--result", f"{tmp_table_dir}/r",
          "--staging-employees", f"{tmp_table_dir}/ce", "--staging-timesheets", f"{tmp_table_dir}/ct",
          "--current-employees", f"{tmp_table_dir}/c"])
    assert _rows(current_employees(spark, f"{tmp_table_dir}/c")) == _rows(dedup_employees(emp))


@pytest.mark.parametrize("step", ["append_batch", "reload_months"])
def test_first_load_that_dies_before_its_mark(spark, tmp_table_dir, monkeypatch, step):
    """Half of the first load's files are there, its mark is not: the next run takes all rows."""
    emp, ts = golden_employees(spark), golden_timesheets(spark)
    paths = [f"{tmp_table_dir}/{n}" for n in ("se", "st", "result")]
    write = getattr(jobs, step)
    late = {"append_batch": lambda df: df.orderBy(F.desc("join_date")).limit(1), "reload_months": lambda df: df.where("date >= '2019-09-01'")}

    def dies(df, path, *args, **kwargs):
        if step == "append_batch":
            late[step](df).write.parquet(f"{path}/batch={EMPTY_MARK.isoformat()}")
        else:
            write(late[step](df), path, *args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(jobs, step, dies)
    with pytest.raises(RuntimeError):
        jobs.run_incremental(spark, emp, ts, *paths)
    monkeypatch.undo()
    jobs.run_incremental(spark, emp, ts, *paths)
    assert _rows(read_staged(spark, paths[0], EMPLOYEES)) == _rows(emp)
    assert _rows(read_partitioned(spark, paths[1], TIMESHEETS)) == _rows(ts)
    assert _rows(read_partitioned(spark, paths[2], BRANCH_SALARY)) == _rows(jobs.full_load(emp, ts))
