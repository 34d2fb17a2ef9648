"""Derive the payroll tables from the generated test tables.

`employees` comes from `supplier` and `timesheets` from `lineitem`, with
integer arithmetic only, so that Spark and an independent SQL engine
derive identical rows. Each binding is one scan of its source table and a
projection; the derived tables keep the source's size and partitioning.

The modulo terms below give the payroll data its shape (repeated
employees, resigned employees, timesheets without an employee, blank and
overnight times); they do not thin out the work: every supplier row becomes
an employee and every lineitem row a timesheet. Timesheets without an
employee carry a negative id, which no supplier has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]

# Types of the source columns the bindings read; passing them skips schema
# inference (a footer read per query) and fails fast if a type changes.
LINEITEM_INPUT = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_shipdate TIMESTAMP_NTZ"
SUPPLIER_INPUT = "s_suppkey BIGINT, s_nationkey INT"

# Fixed values of the bindings.
EPOCH = "1995-01-01"  # day zero of generated join and resign dates
BASE_SALARY = 5_000_000
SALARY_STEP = 500_000
RAISE = 2_500_000
CHECKIN_BASE_SECONDS = 21_600  # 06:00:00
CHECKOUT_BASE_SECONDS = 50_400  # 14:00:00
OVERNIGHT_CHECKOUT_SECONDS = 18_000  # 05:00:00


def _hms(seconds: str) -> str:
    """Spark SQL text: HH:mm:ss of a second-of-day expression (no format_string, which is slow)."""
    parts = [f"{seconds} div 3600", f"{seconds} % 3600 div 60", f"{seconds} % 60"]
    return "concat_ws(':', " + ", ".join(f"lpad(CAST({p} AS STRING), 2, '0')" for p in parts) + ")"


def employees_from_supplier(supplier: DataFrame) -> DataFrame:
    """Employee rows: base suppliers, a raised copy of every 7th, an exact copy of every 11th.

    One scan of `supplier`; the copies come from an `explode` of one to
    three salaries per supplier row. Written as Spark SQL expressions, which
    cost a handful of JVM calls to build instead of one per function.
    """
    salary = f"CAST({BASE_SALARY} + {SALARY_STEP} * (s_suppkey % 20) AS INT)"
    join_offset = "CAST(s_suppkey * 37 % 1800 AS INT)"
    resign_offset = f"{join_offset} + 400 + CAST(s_suppkey % 300 AS INT)"
    return supplier.selectExpr(
        "CAST(s_suppkey AS INT) AS employe_id",
        "CAST(s_nationkey AS INT) AS branch_id",
        f"explode(array_compact(array({salary},"
        f" CASE WHEN s_suppkey % 7 = 0 THEN {salary} + {RAISE} END,"
        f" CASE WHEN s_suppkey % 11 = 0 THEN {salary} END))) AS salary",
        f"date_format(date_add(DATE'{EPOCH}', {join_offset}), 'yyyy-MM-dd') AS join_date",
        f"CASE WHEN s_suppkey % 4 = 1"
        f" THEN date_format(date_add(DATE'{EPOCH}', {resign_offset}), 'yyyy-MM-dd') ELSE '' END AS resign_date",
    )


def timesheets_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One timesheet per lineitem row (Spark SQL expressions, see above)."""
    checkin_s = f"({CHECKIN_BASE_SECONDS} + 600 * (l_partkey % 18))"
    checkout_s = (
        f"(CASE WHEN l_linenumber = 7 THEN {OVERNIGHT_CHECKOUT_SECONDS}"
        f" WHEN l_linenumber = 6 AND l_orderkey % 5 = 0 THEN {checkin_s}"
        f" ELSE {CHECKOUT_BASE_SECONDS} + 36 * (l_orderkey % 600) END)"
    )
    return lineitem.selectExpr(
        "CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS timesheet_id",
        "CAST(CASE WHEN l_partkey % 10 = 9 THEN -l_suppkey ELSE l_suppkey END AS INT) AS employee_id",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS date",  # yyyy-MM-dd, no time zone involved
        f"CASE WHEN l_orderkey % 23 = 0 THEN '' ELSE {_hms(checkin_s)} END AS checkin",
        f"CASE WHEN l_partkey % 29 = 0 THEN '' ELSE {_hms(checkout_s)} END AS checkout",
    )


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees_from_supplier(read_table(spark, sf_dir, "supplier", SUPPLIER_INPUT))


def load_timesheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem", LINEITEM_INPUT)
    return timesheets_from_lineitem(lineitem)


# SQL text of the same bindings, for an independent engine (DuckDB dialect).
# `employees` and `timesheets` are CTE names; append further CTEs after it.
BINDINGS_SQL = """
WITH emp_base AS (
    SELECT s_suppkey,
           CAST(s_suppkey AS INTEGER) AS employe_id,
           CAST(s_nationkey AS INTEGER) AS branch_id,
           CAST(5000000 + 500000 * (s_suppkey % 20) AS INTEGER) AS salary,
           strftime(DATE '1995-01-01' + CAST(s_suppkey * 37 % 1800 AS INTEGER), '%Y-%m-%d') AS join_date,
           CASE WHEN s_suppkey % 4 = 1
                THEN strftime(DATE '1995-01-01'
                              + CAST(s_suppkey * 37 % 1800 + 400 + s_suppkey % 300 AS INTEGER), '%Y-%m-%d')
                ELSE '' END AS resign_date
    FROM supplier
), employees AS (
    SELECT employe_id, branch_id, salary, join_date, resign_date FROM emp_base
    UNION ALL
    SELECT employe_id, branch_id, CAST(salary + 2500000 AS INTEGER), join_date, resign_date
    FROM emp_base WHERE s_suppkey % 7 = 0
    UNION ALL
    SELECT employe_id, branch_id, salary, join_date, resign_date FROM emp_base WHERE s_suppkey % 11 = 0
), ts_base AS (
    SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_shipdate,
           21600 + 600 * (l_partkey % 18) AS ci
    FROM lineitem
), ts_secs AS (
    SELECT *,
           CASE WHEN l_linenumber = 7 THEN 18000
                WHEN l_linenumber = 6 AND l_orderkey % 5 = 0 THEN ci
                ELSE 50400 + 36 * (l_orderkey % 600) END AS co
    FROM ts_base
), timesheets AS (
    SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS timesheet_id,
           CAST(CASE WHEN l_partkey % 10 = 9 THEN -l_suppkey ELSE l_suppkey END AS INTEGER) AS employee_id,
           strftime(l_shipdate, '%Y-%m-%d') AS date,
           CASE WHEN l_orderkey % 23 = 0 THEN ''
                ELSE printf('%02d:%02d:%02d', ci // 3600, (ci % 3600) // 60, ci % 60) END AS checkin,
           CASE WHEN l_partkey % 29 = 0 THEN ''
                ELSE printf('%02d:%02d:%02d', co // 3600, (co % 3600) // 60, co % 60) END AS checkout
    FROM ts_secs
)"""
