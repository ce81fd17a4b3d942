"""Batch readers for the source files, and views over them."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.schemas import SOURCE_SCHEMAS, field_types

log = logging.getLogger(__name__)

ARRIVAL = "_arrival"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` (file, folder or glob) exists on its own file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return bool(found)


def read_source(
    spark: SparkSession, name: str, path: str, run_ts: datetime | None = None, multi_line: bool = False
) -> DataFrame:
    """One source as a bronze frame: the declared columns as text, plus ingestion metadata.

    Columns are found by the names in the header, in any order, others are left out; a
    missing one is an error, and so is a file whose header differs from the others'. Quotes
    inside quoted text are doubled. With `multi_line` quoted text may hold line ends, but a
    file is then read by one task. Numbers and times are read by the layers that follow.
    `_arrival` is the position of the row in its file (file, block, row within the
    block), so that "first" and "last" copies stay defined on a splittable scan.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    wanted = list(field_types(SOURCE_SCHEMAS[name]))
    if missing := [c for c in wanted if c not in header]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    schema = ", ".join(f"`{c}` string" for c in header)
    rows = spark.read.options(**options, enforceSchema=False).csv(path, schema=schema)
    return rows.select(
        *wanted,
        F.lit(run_ts).alias("_ingested_at"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ARRIVAL),
    )


def read_sources(
    spark: SparkSession, folder: str, template: str = "{name}.csv", run_ts: datetime | None = None
) -> dict[str, DataFrame]:
    """All sources present under `folder`; a missing one is skipped with a note."""
    run_ts = run_ts or datetime.now(timezone.utc)
    found: dict[str, DataFrame] = {}
    for name in SOURCE_SCHEMAS:
        path = f"{folder.rstrip('/')}/{template.format(name=name)}"
        if path_exists(spark, path):
            found[name] = read_source(spark, name, path, run_ts)
        else:
            log.info("source %s not found at %s, skipped", name, path)
    return found


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose frames to SQL under `<prefix><name>`."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
