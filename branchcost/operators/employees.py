"""Employee deduplication and preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchcost.functions import STILL_EMPLOYED_DATE, is_blank
from branchcost.schemas import EMPLOYEE_COLUMNS

# Highest salary wins (numeric order, nulls last); remaining ties are broken
# on the other columns so the kept row does not depend on input order.
def dedup_order() -> list:
    return [
        F.col("salary").desc_nulls_last(),
        F.col("branch_id").asc_nulls_last(),
        F.col("join_date").asc_nulls_last(),
        F.col("resign_date").asc_nulls_last(),
    ]


def dedup_employees(employees: DataFrame) -> DataFrame:
    """One row per employe_id: the row with the highest salary.

    `row_number() = 1` is planned as a WindowGroupLimit, whose partial step
    runs before the shuffle and keeps one row per id and input partition,
    so an id with very many copies never reaches one task whole.
    """
    w = Window.partitionBy("employe_id").orderBy(*dedup_order())
    return (
        employees.select(*EMPLOYEE_COLUMNS)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def duplicate_ids(employees: DataFrame) -> DataFrame:
    """Ids that appear on more than one row, with their row count `n`."""
    return employees.groupBy("employe_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def employees_period_ready(employees: DataFrame) -> DataFrame:
    """Deduplicated employees whose blank resign date reads '2900-01-01'."""
    return dedup_employees(employees).withColumn(
        "resign_date",
        F.when(is_blank("resign_date"), F.lit(STILL_EMPLOYED_DATE)).otherwise(F.col("resign_date")),
    )
