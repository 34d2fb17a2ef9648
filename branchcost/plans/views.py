"""Temp views for SQL users.

`register_views` names the inputs and the two results so that queries
written against the original tables keep working through `spark.sql`:

    register_views(spark, employees_df, timesheets_df)
    spark.sql("SELECT * FROM branch_salary WHERE year = 2019 AND month = 8")

The views are lazy plans: each SQL query runs the engine's plan, and
Catalyst pushes the query's filters and projections into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchcost.plans.jobs import full_load, salary_by_period


def register_views(spark: SparkSession, employees: DataFrame, timesheets: DataFrame) -> list[str]:
    views = {
        "employees": employees,
        "timesheets": timesheets,
        "branch_salary": full_load(employees, timesheets),
        "salary_period": salary_by_period(employees, timesheets),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
