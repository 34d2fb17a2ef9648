"""SparkSession helpers.

The library never builds its own session inside a transform; jobs take
the caller's session. `build_session` is for tests, bench and local runs.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings the engine relies on: ANSI so malformed text fails
# instead of turning into null, AQE so joins and shuffles are re-planned on
# runtime sizes (all Spark 4 defaults, set in case a cluster changed them).
#
# Not set, on purpose: the time zone (dates and clock times are DATE /
# TIMESTAMP_NTZ and spans come from clock fields, so no result depends on
# it; local sessions built here use UTC all the same) and the partition
# overwrite mode (each writer states static or dynamic itself), so the
# user's own queries and writes keep the session's semantics.
ENGINE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "branchcost") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BRANCHCOST_DRIVER_MEMORY", "8g"))
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the session-level settings on a session built elsewhere."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    whose driver and tasks share one machine, may leave it unset; then a
    temporary folder is chosen here, and removed when Python ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="branchcost-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers, which may not have it installed.

    Once per application: a zip of the package goes out with Spark's files.
    """
    sc = spark.sparkContext
    if getattr(sc, "_branchcost_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="branchcost-"), "branchcost_package")
    sc.addPyFile(shutil.make_archive(base, "zip", root_dir=root, base_dir="branchcost"))
    sc._branchcost_shipped = True


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted when the driver's Python ends.

    For tables that a lazy result still reads; what a job is done with is
    deleted at once (`snapshot`).
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/branchcost-scratch/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete_if_running, spark, path)
    return path


def _delete_if_running(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        delete_path(spark, path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` as Parquet in a scratch folder and read it back, for a lazy result."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def snapshot(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """Write `df` as Parquet in the shared checkpoint folder; yield it read back.

    Cuts the lineage like a reliable checkpoint, but columnar: a later step
    that reads the snapshot (for example a write that overwrites a table
    `df` was computed from) reads these files, not the original inputs, and
    a lost executor is recovered from them. The snapshot is the job's own
    intermediate data and is deleted when the block ends; every action that
    reads it must run inside the block.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/branchcost-snapshots/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)
