"""Sources: CSV and Parquet readers and the test-table bindings."""

from branchcost.sources.bindings import (
    BINDINGS_SQL,
    employees_from_supplier,
    load_employees,
    load_timesheets,
    read_table,
    timesheets_from_lineitem,
)
from branchcost.sources.readers import (
    read_employees_csv,
    read_or_empty,
    read_partitioned,
    read_timesheets_csv,
    table_exists,
    table_name,
    with_period_columns,
)

__all__ = [
    "BINDINGS_SQL",
    "employees_from_supplier",
    "load_employees",
    "load_timesheets",
    "read_employees_csv",
    "read_or_empty",
    "read_partitioned",
    "read_table",
    "read_timesheets_csv",
    "table_exists",
    "table_name",
    "timesheets_from_lineitem",
    "with_period_columns",
]
