"""The current employees: the staging table's deduplication, kept from load to load.

One row per employee id, partitioned by a hash bucket of the id. A load
deduplicates only the batches that the table does not hold yet, and merges
them with the buckets they fall into; the other buckets are neither read nor
written. Readers need no deduplication, so no shuffle either.

The table's mark names the staging mark that it stands for. It is withdrawn
before a merge and committed after it, so a table with a mark is complete up
to that mark, and one that a merge left half-written is made anew from the
staging table. Batches of loads that ran without this table are taken up by
the next merge.

The number of buckets is part of the partitions' names; a table of another
number is made anew as well. A load with many more new ids than buckets
rewrites the table, which costs about as much as deduplicating it would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchcost.operators import dedup_employees
from branchcost.schemas import EMPLOYEES
from branchcost.session import snapshot
from branchcost.sinks.staging import (
    _partition_values,
    commit_mark,
    committed_mark,
    read_staged,
    staged_mark,
    withdraw_mark,
)
from branchcost.sinks.writers import overwrite_by, replace_partitions
from branchcost.sources import read_partitioned

BUCKET = "bucket"
BUCKETS = 64


def _bucket(buckets: int) -> Column:
    return F.format_string("%d-of-%d", F.pmod(F.hash("employe_id"), F.lit(buckets)), F.lit(buckets))


def _has_buckets(spark: SparkSession, target: str, buckets: int) -> bool:
    return all(b.endswith(f"-of-{buckets}") for (b,) in _partition_values(spark, target, BUCKET))


def keep_current(spark: SparkSession, target: str, staging_path: str, buckets: int = BUCKETS) -> None:
    """Bring the current employees at `target` up to the staging table's mark."""
    mark = staged_mark(spark, staging_path, EMPLOYEES, "join_date")
    known = committed_mark(spark, target)
    if known is None or known > mark or not _has_buckets(spark, target, buckets):
        everyone = dedup_employees(read_staged(spark, staging_path, EMPLOYEES))
        overwrite_by(everyone.withColumn(BUCKET, _bucket(buckets)), target, BUCKET)
    elif known < mark:
        joined = dedup_employees(read_staged(spark, staging_path, EMPLOYEES, since=known))
        with snapshot(joined.withColumn(BUCKET, _bucket(buckets)), "joined") as new:
            # the semi-join on the partition column prunes the scan to the buckets touched
            schema = T.StructType([*EMPLOYEES.fields, T.StructField(BUCKET, T.StringType())])
            before = read_partitioned(spark, target, schema).join(new.select(BUCKET).distinct(), BUCKET, "left_semi")
            merged = dedup_employees(before.unionByName(new)).withColumn(BUCKET, _bucket(buckets))
            with snapshot(merged, "current") as rows:
                withdraw_mark(spark, target)
                replace_partitions(rows, target, BUCKET)
    commit_mark(spark, target, mark)


def current_employees(spark: SparkSession, target: str) -> DataFrame:
    """One row per employee id, as `dedup_employees` of the staging table gives it."""
    if committed_mark(spark, target) is None:
        raise ValueError(f"{target} holds no committed employees; run keep_current or an incremental load with it first")
    return read_partitioned(spark, target, EMPLOYEES)
