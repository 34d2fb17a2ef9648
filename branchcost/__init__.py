"""branchcost: payroll cost per branch and month on Spark DataFrames.

From an employee table and a timesheet table it computes hours worked,
salary paid and salary per hour for every branch and month, and the salary
of everyone employed in a month; as a full load, an incremental load by
high-water mark and a reload of a single month.
"""

__version__ = "0.1.0"
