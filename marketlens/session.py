"""Session settings and the shared folder for tables written between steps."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key also where that costs the next step a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # recording the call site of every column function triples the round trips to the JVM
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = ADAPTIVE | {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 * 1024 * 1024) -> int:
    """Sets the number of shuffle partitions adaptive execution starts from, so that the
    given input makes partitions of about `partition_bytes`; small ones are merged at
    run time. Never below the session's own setting."""
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes / partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, named by `spark.checkpoint.dir`.

    Only where the session names none and runs on a single machine is a local one made
    and set, so that later calls find the same folder; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="marketlens-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back.

    Used where a result is read several times by separate jobs: it cuts the
    lineage, survives the loss of executors and gives the reader real file sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Jobs run within hand rows to Python in batches of about `most_bytes`; a batch is held
    several times, as rows and as bytes by the JVM and by the worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
