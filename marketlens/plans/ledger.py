"""What a batch run has finished, so that a run that stopped can go on where it stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.files import path_exists


def fingerprint(spark: SparkSession, sources: Mapping[str, DataFrame]) -> str:
    """Changes whenever a file of a source does: its name, length or time. Sources that are
    not read from files have another fingerprint every time."""
    seen = []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in sorted(sources):
        files = sorted(sources[name].inputFiles())
        if not files:
            return uuid.uuid4().hex
        for file in files:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
            status = path.getFileSystem(conf).getFileStatus(path)
            seen.append((name, file, status.getLen(), status.getModificationTime()))
    return hashlib.md5(json.dumps(seen).encode()).hexdigest()


class Ledger:
    """A file per finished stage below `folder`, holding the fingerprint it was run on.

    A stage's fingerprint is made of its name, what it was told and the fingerprint of the
    stage before, so a change in the sources, or of an early stage, undoes all that follow.
    A stage is entered after its tables are written: one that stopped half way is run again,
    which replaces what it left.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def finished(self, stage: str) -> str | None:
        """The fingerprint of the last finished run of a stage."""
        path = f"{self.folder}/{stage}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        rows = self.spark.read.schema("stage string, fingerprint string, finished_at timestamp").json(path).collect()
        return rows[0]["fingerprint"] if rows else None

    def finish(self, stage: str, mark: str) -> None:
        row = [(stage, mark, datetime.now(timezone.utc))]
        frame = self.spark.createDataFrame(row, "stage string, fingerprint string, finished_at timestamp")
        frame.coalesce(1).write.mode("overwrite").json(f"{self.folder}/{stage}")

    def run(self, start: str, stages: Sequence[tuple[str, str, Callable[[], None]]]) -> list[str]:
        """Runs (name, what it was told, step) in order from the fingerprint `start`; returns
        the names of the stages that were not skipped."""
        mark, done = start, []
        for name, told, step in stages:
            mark = hashlib.md5(f"{mark}|{name}|{told}".encode()).hexdigest()
            if self.finished(name) != mark:
                step()
                self.finish(name, mark)
                done.append(name)
        return done
