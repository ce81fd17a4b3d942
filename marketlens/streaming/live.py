"""Running totals and raw event tables kept up to date by streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens.functions.columns import as_timestamp, money, money_sum
from marketlens.sources.files import path_exists
from marketlens.sources.schemas import TOPICS
from marketlens.streaming import compaction
from marketlens.streaming.records import of_type

# Table per event type and metric keys.
LIVE_TABLES = {
    "order_created": "live_order_stream",
    "payment_processed": "live_payment_stream",
    "delivery_update": "live_delivery_stream",
    "inventory_adjustment": "live_inventory_stream",
}
# Events of unknown type, and records that could not be read.
UNROUTED = "live_unrouted"
METRICS = [
    "live_revenue_total",
    "live_orders_total",
    "live_payments_total",
    "live_payment_failures_total",
    "live_delivery_events_total",
    "live_sla_breaches_total",
]

# Number of complete results kept by the totals sink before the oldest is replaced.
_SLOTS = 16
_QUERY = "query"


def _query_id(batch: DataFrame) -> str:
    """Id of the streaming query a batch belongs to; kept in its checkpoint over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def owners(spark: SparkSession, path: str) -> set[str]:
    """Ids of the queries that have written below `path`."""
    if not path_exists(spark, f"{path}/{_QUERY}=*"):
        return set()
    rows = spark.read.parquet(path).select(F.col(_QUERY).cast("string")).distinct()
    return {r[0] for r in rows.collect()}


def _check_owner(spark: SparkSession, path: str, checkpoint: str, replace: bool) -> None:
    """A table written by a query of another checkpoint is not touched unless told so."""
    known = owners(spark, path)
    own = None
    if path_exists(spark, f"{checkpoint}/metadata"):
        own = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    if known and own not in known and not replace:
        raise ValueError(f"{path} belongs to another streaming query; pass replace=True to take it over")


def _increments() -> dict[str, Column]:
    """Increment of each metric for one event, null where the event does not count."""
    kind, one = F.col("event_type"), F.lit(1)
    sold = (kind == "order_created") & (F.col("status") == "completed")
    paid = kind == "payment_processed"
    moved = kind == "delivery_update"
    return {
        "live_revenue_total": F.when(sold, F.coalesce(F.col("amount"), F.lit(0.0))),
        "live_orders_total": F.when(sold, one),
        "live_payments_total": F.when(paid, one),
        "live_payment_failures_total": F.when(paid & (F.col("result") == "failed"), one),
        "live_delivery_events_total": F.when(moved, one),
        "live_sla_breaches_total": F.when(moved & F.col("sla_breach"), one),
    }


def running_totals(events: DataFrame) -> DataFrame:
    """Total per metric, for batch and streaming input alike.

    Each event becomes one row per metric it counts for; increments are summed per
    task before the shuffle, so six keys are no bottleneck.
    """
    entries = [
        F.struct(F.lit(key).alias("metric_key"), money(value).alias("delta")) for key, value in _increments().items()
    ]
    counted = F.filter(F.array(*entries), lambda e: e["delta"].isNotNull())
    return (
        events.select(F.inline(counted))
        .groupBy("metric_key")
        .agg(F.sum("delta").cast("double").alias("metric_value"))
    )


def _write_totals(path: str) -> Callable[[DataFrame, int], None]:
    """A batch replaces the slot of its query and number, so a repeated one changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumns(
            {"updated_at": F.current_timestamp(), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        target = f"{path}/{_QUERY}={_query_id(batch)}/slot={batch_id % _SLOTS}"
        stamped.coalesce(1).write.mode("overwrite").parquet(target)

    return write


def start_totals(
    events: DataFrame, path: str, checkpoint: str, interval: str | None = None, replace: bool = False
) -> StreamingQuery:
    """Keeps the totals table at `path`: until the input is used up, or every `interval`.

    Totals belong to the query that made them. A new checkpoint is a new query, which starts
    from nothing; it takes over an existing table only with `replace`.
    """
    _check_owner(events.sparkSession, path, checkpoint, replace)
    writer = running_totals(events).writeStream.outputMode("complete").foreachBatch(_write_totals(path))
    return _start(writer, checkpoint, interval)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """Latest value per metric, of the query that wrote last."""
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max_by(_QUERY, "updated_at")).scalar()
    latest = F.max_by(F.struct("metric_value", "updated_at"), "batch_id").alias("_last")
    return rows.filter(F.col(_QUERY) == newest).groupBy("metric_key").agg(latest).select("metric_key", "_last.*")


def _write_events(path: str) -> Callable[[DataFrame, int], None]:
    """One write per batch, partitioned by table, below a folder named by query and batch."""
    tables = F.lit(UNROUTED)
    for event_type, table in LIVE_TABLES.items():
        tables = F.when(F.col("event_type") == event_type, table).otherwise(tables)

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/{_QUERY}={_query_id(batch)}/batch_id={batch_id}"
        batch.withColumn("table", tables).write.mode("overwrite").partitionBy("table").parquet(target)

    return write


def start_event_tables(events: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keeps the four raw event tables, and the unrouted events, below `path`.

    Batches of another query stay beside those of this one: two checkpoints over one feed
    hold its events twice, nothing is replaced. `compaction.compact` keeps the number of
    files low.
    """
    writer = events.writeStream.outputMode("append").foreachBatch(_write_events(path))
    return _start(writer, checkpoint, interval)


def read_events(spark: SparkSession, path: str, event_type: str, query: str | None = None) -> DataFrame:
    """Events of one type with the columns of its table; other tables are pruned. Of all
    queries that wrote here, or of the one named."""
    rows = compaction.read(spark, path).filter(F.col("table") == LIVE_TABLES[event_type])
    return of_type(rows if query is None else rows.filter(F.col(_QUERY) == query), event_type)


def read_unrouted(spark: SparkSession, path: str) -> DataFrame:
    """Key and type of the events that belong to no table."""
    return compaction.read(spark, path).filter(F.col("table") == UNROUTED).select("key", "event_type")


def revenue_by_hour(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Revenue and number of completed orders per hour of event time, each event once.

    For streams in append mode: an hour is given out when the watermark, `delay` behind the
    latest event, has passed its end, and never changes after that. Events that come again
    within `delay` are dropped, and so is what is later than the watermark.
    """
    timed = events.withColumn("event_time", as_timestamp("event_ts").cast("timestamp")).withWatermark("event_time", delay)
    once = timed.dropDuplicatesWithinWatermark(["event_type", "key"])
    sold = once.filter((F.col("event_type") == "order_created") & (F.col("status") == "completed"))
    hours = sold.groupBy(F.window("event_time", "1 hour")).agg(money_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    return hours.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "revenue", "orders")


def start_revenue_by_hour(
    events: DataFrame, path: str, checkpoint: str, interval: str | None = None, delay: str = "10 minutes"
) -> StreamingQuery:
    """Adds closed hours to the table at `path`; the sink's own log keeps each batch once."""
    writer = revenue_by_hour(events, delay).writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, checkpoint, interval)


def _start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def consumer_lag(progress: dict) -> dict[str, int]:
    """Records behind the newest offset, per topic, from a Kafka query's last progress."""
    behind: dict[str, int] = dict.fromkeys(TOPICS.values(), 0)
    for source in progress.get("sources", []):
        done, newest = _offsets(source.get("endOffset")), _offsets(source.get("latestOffset"))
        for topic, partitions in newest.items():
            seen = done.get(topic, {})
            behind[topic] = behind.get(topic, 0) + sum(
                max(0, int(end) - int(seen.get(p, 0))) for p, end in partitions.items()
            )
    return behind


def _offsets(value) -> dict:
    parsed = json.loads(value) if isinstance(value, str) else value
    return parsed if isinstance(parsed, dict) else {}
