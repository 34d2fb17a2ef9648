"""Readers for employee and timesheet input and for result tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from branchcost.functions import month_of_text, null_to_blank, year_of_text
from branchcost.schemas import EMPLOYEES, TIMESHEETS

HEADER_THREADS = 32


def _header_line(spark: SparkSession, path) -> str | None:
    """First line of a file (a Hadoop path), unpacked as its name's ending says; None for an empty file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The CSV files at `path` by their header line; empty files have none and no rows.

    The first block of a file is opened for its line, `HEADER_THREADS` files
    at a time; no Spark job runs and no other line is read.
    """
    jvm = spark.sparkContext._jvm
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = list(pool.map(lambda f: _header_line(spark, f), files))
    groups: dict[str, list[str]] = {}
    for line, f in sorted(zip(lines, (f.toString() for f in files)), key=lambda x: x[1]):
        if line is not None:
            groups.setdefault(line, []).append(f)
    return groups


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row, its columns taken by name, in any order.

    Every file is read by its own header: the files of one header are one
    scan, the scans are united by name. A column that any header lacks stops
    the job; further columns are ignored. FAILFAST: a malformed row stops
    the job instead of turning into nulls.
    """
    groups = list(files_by_header(spark, path).values())
    if len(groups) < 2:
        return _read_one_header(spark, path, schema)
    scans = [_read_one_header(spark, files, schema) for files in groups]
    return reduce(DataFrame.unionByName, scans)


def _read_one_header(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV files of one header, which Spark checks in every file (`enforceSchema` off)."""
    header = spark.read.option("header", True).csv(path if isinstance(path, str) else path[0]).columns
    wanted = {f.name: f.dataType for f in schema.fields}
    missing = [name for name in wanted if name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {header}")
    as_found = T.StructType([T.StructField(c, wanted.get(c, T.StringType()), True) for c in header])
    return (
        spark.read.schema(as_found)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
        .select(*wanted)
    )


def read_employees_csv(spark: SparkSession, path: str) -> DataFrame:
    """Employee CSV with a header row; a blank resign date comes back as ''."""
    df = _read_csv(spark, path, EMPLOYEES)
    return df.withColumn("resign_date", null_to_blank("resign_date"))


def read_timesheets_csv(spark: SparkSession, path: str) -> DataFrame:
    """Timesheet CSV with a header row; blank times come back as ''."""
    df = _read_csv(spark, path, TIMESHEETS)
    return df.withColumn("checkin", null_to_blank("checkin")).withColumn("checkout", null_to_blank("checkout"))


def table_name(target: str) -> str | None:
    """Catalog name of a target written ``table:name``; None for a path."""
    return target.removeprefix("table:") if target.startswith("table:") else None


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when `path` holds a readable table (a committed directory or a catalog table)."""
    if table_name(path):
        return spark.catalog.tableExists(table_name(path))
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath.suffix("/_SUCCESS")) or (
        fs.exists(hpath) and len(fs.listStatus(hpath)) > 0
    )


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table written with partitionBy and restore the schema's column order.

    Partition columns come back last from a directory scan; the schema is
    passed so no inference pass runs and an empty table still has columns.
    """
    if table_name(path):
        return spark.table(table_name(path)).select(*schema.fieldNames())
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if table_exists(spark, path):
        return read_partitioned(spark, path, schema)
    return spark.createDataFrame([], schema)


def with_period_columns(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add integer year and month derived from a yyyy-MM-dd text column.

    Same parsing as the operators: a blank date gives a null period.
    """
    return df.withColumn("year", year_of_text(date_col)).withColumn("month", month_of_text(date_col))
