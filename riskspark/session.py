"""Spark session defaults shared by tests, bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every query in this package relies on: UTC wall clock (timestamps in the
# inputs are naive), ANSI arithmetic (so helpers use try_* forms explicitly), and AQE
# with skew-join splitting and partition coalescing for runtime re-planning.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskspark") -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster the master and ``spark.checkpoint.dir`` come from the launcher; only a
    local run without a configured checkpoint directory gets a scratch one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is also the executor; give it room (cluster
            # launches size executors through their own configuration)
            builder = builder.config("spark.driver.memory", os.environ.get("RISKSPARK_DRIVER_MEMORY", "8g"))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static confs on a shared session: keep what is there
            pass
    return spark


@contextmanager
def arrow_by_rows(spark: SparkSession) -> Iterator[None]:
    """While it lasts, batches for Python are bounded by their rows alone: Spark measures the bytes of all columns
    anew for every row, which costs more than the rows. For jobs that run inside it on short rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str((1 << 31) - 1))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def is_local(master: str | None) -> bool:
    """Whether driver and executors are one process (so a machine-local folder is shared)."""
    return master == "local" or (master or "").startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a local one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Callers
    that write something ask for it; queries that do not need no folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not is_local(sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="riskspark-ckpt-", dir=os.environ.get("RISKSPARK_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def scratch(spark: SparkSession, path: str) -> str:
    """``path``, remembered as a folder of this application that nothing needs once its results are written."""
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the stage tables, stream folders and work folders that this application has made; returns how many.

    Results are lazy and read them, so call it when results are written and streams have stopped."""
    gone = 0
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return gone


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` once below the checkpoint folder and read it back: several passes over it
    (or a loss of executors) do not compute it again, and what depends on the partitioning
    of the moment, such as partition numbers, stays fixed."""
    path = scratch(df.sparkSession, f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
