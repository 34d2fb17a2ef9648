"""Physical-plan shape: the properties the design for scale relies on."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from branchcost.operators import (
    dedup_employees,
    employees_period_ready,
    period_employee_exploded,
    period_employee_range_join,
    period_list,
    timesheet_employee,
    timesheet_hours,
    timesheets_delta,
    timesheets_in_period,
)
from branchcost.plans.catalog import QUERIES
from branchcost.plans.jobs import full_load, salary_by_period
from branchcost.schemas import STAGED_TIMESHEETS
from branchcost.sinks.writers import reload_months
from branchcost.sources import load_employees, load_timesheets, read_partitioned
from conftest import SF_SMALL


#: Keys without a seeded table: their whole work is the plan of the result.
PAYROLL_PLANS = set(QUERIES) - {k for k in QUERIES if k.startswith("sink_") or k.endswith(("_upsert", "_replace", "_scan", "_lookup"))}


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_flagship_aggregates_before_shuffling(spark):
    p = plan(full_load(load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)))
    assert "partial_sum(work_seconds" in p  # map-side combine per (employee, year, month)
    assert "WindowGroupLimit" in p and "Partial" in p  # dedup limited before its shuffle
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    lineitem_scans = [line for line in p.splitlines() if "ReadSchema: struct<l_" in line]
    assert lineitem_scans
    for line in lineitem_scans:  # 5 of the 16 lineitem columns are read
        fields = line.split("struct<", 1)[1].rstrip(">").split(",")
        assert len(fields) == 5, line


def test_salary_period_expands_and_sums_map_side(spark):
    p = plan(salary_by_period(load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)))
    assert "explode(sequence" in p
    assert "partial_sum(cast(salary" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def _executed(df):
    """Final adaptive plan of a query that has run."""
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """No broadcast joins and low thresholds, as large inputs would have them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_employee_is_split_in_the_row_level_join(spark, no_broadcast):
    emp = load_employees(spark, SF_SMALL)
    ts = load_timesheets(spark, SF_SMALL).withColumn("employee_id", F.expr("IF(timesheet_id % 5 < 4, 1, employee_id)"))
    hot = timesheet_employee(timesheet_hours(ts.repartition(8, "timesheet_id")), dedup_employees(emp))
    rows, p = _executed(hot)
    assert len(rows) == 6000
    assert "skew=true" in p.split("Initial Plan")[0], p


def test_period_join_streams_the_employees(spark, no_broadcast):
    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    for join in (period_employee_range_join, period_employee_exploded):
        p = plan(join(period_list(ts), employees_period_ready(emp)), "simple")
        assert "NestedLoop" not in p and "CartesianProduct" not in p
        assert "Inner" in p and "LeftOuter" not in p


def test_period_filter_prunes_partitions_and_pushes_down(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "staging")
    reload_months(load_timesheets(spark, SF_SMALL), path, materialize=False)
    staged = read_partitioned(spark, path, STAGED_TIMESHEETS)
    p = plan(timesheets_in_period(staged, 1999, 6))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p and "= 1999)" in p
    assert "GreaterThanOrEqual(date,1999)" in p and "LessThan(date,2000)" in p


def test_delta_filter_is_a_literal_pushed_to_the_source(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "staging")
    ts = load_timesheets(spark, SF_SMALL)
    reload_months(ts.filter(F.col("date") <= "1999-06-17"), path, materialize=False)
    staged = read_partitioned(spark, path, STAGED_TIMESHEETS)
    source_path = os.path.join(tmp_table_dir, "source")
    ts.write.parquet(source_path)
    p = plan(timesheets_delta(spark.read.parquet(source_path), staged))
    assert "GreaterThanOrEqual(date,1999)" in p and "1999-06-01" in p
    assert "Subquery" not in p and p.count("ReadSchema") == 1  # the staging table is not part of the plan


def test_upsert_reads_only_touched_months(spark, tmp_table_dir):
    from branchcost.operators import merge_branch_salary
    from branchcost.schemas import BRANCH_SALARY, PERIOD_KEY
    from branchcost.sinks.writers import write_partitioned_overwrite
    from branchcost.sources import read_or_empty

    emp, ts = load_employees(spark, SF_SMALL), load_timesheets(spark, SF_SMALL)
    path = os.path.join(tmp_table_dir, "result")
    write_partitioned_overwrite(full_load(emp, ts), path)
    delta = full_load(emp, ts.filter(F.col("date") >= "2001-01-01"))
    existing = read_or_empty(spark, path, BRANCH_SALARY)
    touched = existing.join(delta.select(*PERIOD_KEY).distinct(), PERIOD_KEY, "left_semi")
    assert "dynamicpruning" in plan(merge_branch_salary(touched, delta), "simple")


@pytest.mark.parametrize("key", sorted(PAYROLL_PLANS))
def test_generated_methods_are_small_enough_to_be_compiled(spark, key):
    """The JVM does not compile methods of more than 8,000 bytes; they run interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[key](spark, SF_SMALL)
        codegen = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", codegen.codegenString(df._jdf.queryExecution().executedPlan()))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) <= 8000
