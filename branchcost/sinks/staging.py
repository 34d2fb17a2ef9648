"""Staging tables whose state is what was committed: batches and marks.

A load writes its rows first and then commits one mark, the latest date that
the table now holds. The next load starts from the committed mark, so what a
load left behind that died before its commit is taken again and replaced.
The mark is an empty file named after the date, in `_marks` of the table's
folder (which Spark's readers skip), or a property of a catalog table: one
atomic step either way.

Employees are staged in batches, partitions named after the mark that the
batch was taken after. A load that is repeated has the same mark and replaces
the same partition. Timesheets are staged by (year, month); a repeated load
replaces the same months.

Marks and months come from the folder listing or the catalog; data files are
opened only for a table without a mark, and then those of its last month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchcost.functions import EMPTY_WATERMARK_DATE, parse_date
from branchcost.operators import high_water_mark
from branchcost.schemas import PERIOD_KEY
from branchcost.session import delete_path
from branchcost.sinks.writers import _save, _session_setting
from branchcost.sources import read_or_empty, read_partitioned, table_exists, table_name

BATCH = "batch"
MARKS = "_marks"
MARK_PROPERTY = "staging.mark"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
EMPTY_MARK = dt.date.fromisoformat(EMPTY_WATERMARK_DATE)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, without those that Spark's readers skip; none if there is no folder."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hpath)]
    return [n for n in names if not n.startswith(".")]


def committed_mark(spark: SparkSession, target: str) -> dt.date | None:
    """The mark committed last; None for a table without one."""
    name = table_name(target)
    if not name:
        marks = _names(spark, f"{target.rstrip('/')}/{MARKS}")
        return dt.date.fromisoformat(max(marks)) if marks else None
    if not spark.catalog.tableExists(name):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return dt.date.fromisoformat(found[MARK_PROPERTY]) if MARK_PROPERTY in found else None


def commit_mark(spark: SparkSession, target: str, mark: dt.date) -> None:
    """Commit `mark`, if it is later than the mark before."""
    before = committed_mark(spark, target)
    if before is not None and before >= mark:
        return
    name = table_name(target)
    if name:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{MARK_PROPERTY}' = '{mark.isoformat()}')")
        return
    folder = f"{target.rstrip('/')}/{MARKS}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{mark.isoformat()}")
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True).close()
    if before is not None:  # the latest counts, so this may be left out by a crash
        delete_path(spark, f"{folder}/{before.isoformat()}")


def withdraw_mark(spark: SparkSession, target: str) -> None:
    """Leave a table without a mark while it is being rewritten."""
    name = table_name(target)
    if name:
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{MARK_PROPERTY}')")
    else:
        delete_path(spark, f"{target.rstrip('/')}/{MARKS}")


def begin_staging(spark: SparkSession, target: str) -> None:
    """Mark a new folder as empty before its first rows, so that a first load that dies is begun again.

    A catalog table appears with all its rows at once and needs no such mark.
    """
    if not table_name(target) and not table_exists(spark, target):
        commit_mark(spark, target, EMPTY_MARK)


def _partition_values(spark: SparkSession, target: str, *columns: str) -> Iterator[tuple[str, ...]]:
    """Values of the partitions of a table, as text, from its folders or the catalog."""
    name = table_name(target)
    if name:
        if not spark.catalog.tableExists(name):
            return
        for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
            found = dict(part.split("=", 1) for part in r[0].split("/"))
            yield tuple(found[c] for c in columns)
        return

    def below(folder: str, rest: tuple[str, ...]) -> Iterator[tuple[str, ...]]:
        if not rest:
            yield ()
            return
        for entry in _names(spark, folder):
            if entry.startswith(f"{rest[0]}="):
                for more in below(f"{folder}/{entry}", rest[1:]):
                    yield (entry.split("=", 1)[1], *more)

    yield from below(target.rstrip("/"), columns)


def staged_months(spark: SparkSession, target: str) -> list[tuple[int, int]]:
    """(year, month) of the partitions of a staged table, ascending; no data file is opened.

    The partition of rows without a date is no month.
    """
    found = _partition_values(spark, target, *PERIOD_KEY)
    return sorted({(int(y), int(m)) for y, m in found if NULL_PARTITION not in (y, m)})


def staged_period_list(spark: SparkSession, target: str) -> DataFrame:
    """The period list (year, month) of a staged table, from its partitions."""
    kind = T.StructType([T.StructField(c, T.IntegerType()) for c in PERIOD_KEY])
    return spark.createDataFrame(staged_months(spark, target), kind)


def staged_mark(spark: SparkSession, target: str, schema: T.StructType, date_text: str) -> dt.date:
    """Where the next load of a staged table starts: its mark, else its latest date, else 1900-01-01.

    Without a mark, the last month's partition is read for its latest date,
    or the month before if that is empty; a table that is not partitioned by
    month is read whole. Batches without a mark were not committed.
    """
    mark = committed_mark(spark, target)
    if mark is not None:
        return mark
    if not table_exists(spark, target):
        return EMPTY_MARK
    if not set(PERIOD_KEY) <= set(schema.fieldNames()):
        if _has_batches(spark, target):
            return EMPTY_MARK
        return high_water_mark(read_partitioned(spark, target, schema), date_text)
    for year, month in reversed(staged_months(spark, target)):
        if table_name(target):
            rows = spark.table(table_name(target)).where((F.col("year") == year) & (F.col("month") == month))
        else:  # one folder is listed and read
            rows = spark.read.schema(schema).parquet(f"{target.rstrip('/')}/year={year}/month={month}")
        latest = rows.select(F.max(parse_date(date_text))).first()[0]
        if latest is not None:
            return latest
    return EMPTY_MARK


def _has_batches(spark: SparkSession, target: str) -> bool:
    name = table_name(target)
    if name:
        return BATCH in spark.table(name).columns
    return any(_partition_values(spark, target, BATCH))


def _drop_batch(spark: SparkSession, target: str, batch: str) -> None:
    name = table_name(target)
    if name:
        if (batch,) in set(_partition_values(spark, target, BATCH)):
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({BATCH} = '{batch}')")
    else:
        delete_path(spark, f"{target.rstrip('/')}/{BATCH}={batch}")


def append_batch(df: DataFrame, target: str, after: dt.date, date_text: str = "join_date") -> int:
    """Append the rows taken after the mark `after`; commit their latest date and return their number.

    Rows that a load of the same mark left behind are replaced. The number and
    the latest date are observed while the rows are written, so `df` is read
    once. No rows change nothing.
    """
    spark = df.sparkSession
    name = table_name(target)
    if not name and any("." in n and "=" not in n for n in _names(spark, target) if not n.startswith("_")):
        raise ValueError(f"{target} holds files outside batches; load it into a new folder with append_batch")
    batch = after.isoformat()
    _drop_batch(spark, target, batch)
    seen = Observation("batch")
    rows = df.withColumn(BATCH, F.lit(batch)).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(parse_date(date_text)).alias("latest")
    )
    if name and spark.catalog.tableExists(name):
        with _session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    else:
        _save(rows.write.mode("overwrite").partitionBy(BATCH), target, overwrite="dynamic")
    found = seen.get
    if found["rows"] and found["latest"] is not None:
        commit_mark(spark, target, found["latest"])
    return found["rows"]


def read_staged(spark: SparkSession, target: str, schema: T.StructType, since: dt.date | None = None) -> DataFrame:
    """The rows of a staging table; those of a batch that was not committed are left out.

    A batch is committed once the mark is later than the one it was taken
    after. With `since`, an earlier mark, only the batches after it are read.
    """
    rows = read_or_empty(spark, target, schema)
    mark = committed_mark(spark, target)
    batches = {b for (b,) in _partition_values(spark, target, BATCH)}
    open_ = sorted(b for b in batches if mark is None or b >= mark.isoformat())
    if not open_ and since is None:
        return rows
    if table_name(target):
        whole = spark.table(table_name(target))
    else:
        whole = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])).parquet(target)
    if open_:
        whole = whole.where(~F.col(BATCH).isin(open_))
    if since is not None:
        whole = whole.where(F.col(BATCH) >= since.isoformat())
    return whole.select(*schema.fieldNames())
