"""Table schemas of the payroll model.

Every column is nullable and there are no keys, as in the source tables.
Raw text columns stay strings until a transform parses them, so that a
blank field can be told apart from a malformed one.
"""

from pyspark.sql import types as T

# Raw employee input: one row per employee record; an id may repeat.
EMPLOYEES = T.StructType(
    [
        T.StructField("employe_id", T.IntegerType(), True),
        T.StructField("branch_id", T.IntegerType(), True),
        T.StructField("salary", T.IntegerType(), True),
        T.StructField("join_date", T.StringType(), True),  # yyyy-MM-dd
        T.StructField("resign_date", T.StringType(), True),  # yyyy-MM-dd, '' = employed
    ]
)

# Raw timesheet input: one row per worked day of an employee.
TIMESHEETS = T.StructType(
    [
        T.StructField("timesheet_id", T.LongType(), True),
        T.StructField("employee_id", T.IntegerType(), True),
        T.StructField("date", T.StringType(), True),  # yyyy-MM-dd
        T.StructField("checkin", T.StringType(), True),  # HH:mm:ss, '' = missing
        T.StructField("checkout", T.StringType(), True),  # HH:mm:ss, '' = missing
    ]
)

# Timesheet staging table: raw columns plus its (year, month) partition columns.
STAGED_TIMESHEETS = T.StructType(
    TIMESHEETS.fields
    + [T.StructField("year", T.IntegerType(), True), T.StructField("month", T.IntegerType(), True)]
)

# State of the incremental job: seconds worked per employee and month.
EMPLOYEE_MONTH = T.StructType(
    [
        T.StructField("employee_id", T.IntegerType(), True),
        T.StructField("work_seconds", T.LongType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
    ]
)

# Result of the full, incremental and current-period jobs.
BRANCH_SALARY = T.StructType(
    [
        T.StructField("branch_id", T.IntegerType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("total_work_hour", T.DoubleType(), True),
        T.StructField("total_salary", T.LongType(), True),
        T.StructField("cost_per_hour", T.DoubleType(), True),
    ]
)

# Result of the employment-period job; the sum column is literally `sum`.
SALARY_PERIOD = T.StructType(
    [
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("branch_id", T.IntegerType(), True),
        T.StructField("sum", T.LongType(), True),
    ]
)

EMPLOYEE_COLUMNS = EMPLOYEES.fieldNames()
TIMESHEET_COLUMNS = TIMESHEETS.fieldNames()
BRANCH_SALARY_COLUMNS = BRANCH_SALARY.fieldNames()
SALARY_PERIOD_COLUMNS = SALARY_PERIOD.fieldNames()
BRANCH_SALARY_KEY = ["branch_id", "year", "month"]
PERIOD_KEY = ["year", "month"]
