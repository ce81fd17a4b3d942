"""Progress of streaming queries as a table: a row per batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from marketlens.streaming.live import consumer_lag

SCHEMA = (
    "query string, run string, batch_id bigint, started_at string, input_rows bigint, state_rows bigint, "
    "late_rows bigint, watermark string, lag map<string, bigint>"
)


class ProgressTable(StreamingQueryListener):
    """Stores the progress of the session's streaming queries at `path` while registered.

        with ProgressTable(spark, path) as progress:
            live.start_totals(...).awaitTermination()
        progress.read()

    Leaving the block waits until the queries started in it have reported their end. A batch
    without new rows is stored too if it did something else (closed windows); a batch that is
    run again after a failure reports again, and the last report counts.
    """

    def __init__(self, spark: SparkSession, path: str, patience: float = 30.0):
        self.spark, self.path, self.patience = spark, path, patience
        self._running: set[str] = set()
        self._quiet = threading.Condition()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        with self._quiet:
            self._quiet.wait_for(lambda: not self._running, self.patience)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names given by Spark
        with self._quiet:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.spark.createDataFrame([row(json.loads(event.progress.json))], SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(self.path)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._quiet:
            self._running.discard(str(event.runId))
            self._quiet.notify_all()

    def read(self) -> DataFrame:
        return latest(self.spark.read.schema(SCHEMA).parquet(self.path))


def row(progress: dict) -> tuple:
    """A row of the table from a query's progress."""
    states, times = progress.get("stateOperators", []), progress.get("eventTime", {})
    return (
        progress["id"],
        progress["runId"],
        progress["batchId"],
        progress["timestamp"],
        progress.get("numInputRows", 0),
        sum(s.get("numRowsTotal", 0) for s in states),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
        times.get("watermark"),
        consumer_lag(progress),
    )


def latest(reports: DataFrame) -> DataFrame:
    """One row per query and batch that read rows, the last report of each."""
    return reports.where("input_rows > 0").groupBy("query", "batch_id").agg(
        *[F.max_by(c, "started_at").alias(c) for c in ("run", "started_at", "input_rows", "state_rows", "late_rows", "watermark", "lag")]
    )

