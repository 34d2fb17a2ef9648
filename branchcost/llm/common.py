"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchcost.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Words of the mixing and near-duplicate operators: runs without ASCII white space.
SPACE_FREE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor is recovered from these files, and
    several readers of the result do not compute it again. The files are
    deleted when the driver's Python ends, or by `release`.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of `stage_table` that nothing reads any more.

    Also lets the driver collect its garbage, upon which Spark removes the
    shuffle files of the steps that made them; otherwise the disk would hold
    those of all steps of a long job at once.
    """
    for t in tables:
        spark = t.sparkSession
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.stage_path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    gc.collect()
    tables[0].sparkSession.sparkContext._jvm.System.gc()


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Rows go to the Python workers in batches of at most so many rows and about so many bytes.

    For the actions inside the block only: a batch lies in the executor's
    memory outside its heap and again in the Python worker, and 10,000 whole
    texts, Spark's default, are tens of MB in each.
    """
    ours = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(size),
    }
    before = {key: spark.conf.get(key, None) for key in ours}
    try:
        for key, value in ours.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base
