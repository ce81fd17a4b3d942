"""Records of the event topics: sources, JSON encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.columns import as_timestamp
from marketlens.sources.schemas import PAYLOAD_FIELDS, TOPICS, field_types

RECORD_SCHEMA = "topic string, key string, value string, timestamp timestamp"

PAYLOADS = {event_type: field_types(ddl) for event_type, ddl in PAYLOAD_FIELDS.items()}

# All payload fields of all event types together: one parse serves every type.
ALL_FIELDS = {name: kind for fields in PAYLOADS.values() for name, kind in fields.items()}
PAYLOAD_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in ({"event_type": "string"} | ALL_FIELDS).items())


def file_records(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stream of record files (JSON lines) in a folder, at most `max_files` per micro-batch."""
    return spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)


def kafka_records(spark: SparkSession, servers: str, max_records: int = 100_000) -> DataFrame:
    """Stream of the four topics from Kafka, at most `max_records` per micro-batch.

    Needs the Kafka connector on the class path of the cluster. Offsets live in the
    checkpoint of each query, which takes the place of a consumer group.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(TOPICS.values()))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_records)
        .load()
        .select("topic", F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")
    )


def encode(events: DataFrame) -> DataFrame:
    """Business events (one wide row each) as records with a JSON payload.

    A payload holds the fields of its event type only; other fields are left out.
    """
    kind = F.col("event_type")
    wide = events.withColumn("timestamp", F.col("event_ts").cast("string"))

    def field(name: str):
        owners = [t for t, fields in PAYLOADS.items() if name in fields]
        return F.when(kind.isin(owners), F.col(name)).alias(name)

    topic = F.lit(None).cast("string")
    for event_type, name in TOPICS.items():
        topic = F.when(kind == event_type, name).otherwise(topic)
    return wide.select(
        topic.alias("topic"),
        F.col("order_id").alias("key"),
        F.to_json(F.struct(kind, *[field(n) for n in ALL_FIELDS])).alias("value"),
        F.col("event_ts").cast("timestamp").alias("timestamp"),
    )


def decode(records: DataFrame) -> DataFrame:
    """Records with their payload fields; malformed payloads give a null event type."""
    parsed = records.select("key", F.from_json("value", PAYLOAD_SCHEMA).alias("e"))
    return parsed.select("key", "e.*").withColumnRenamed("timestamp", "event_ts")


def of_type(events: DataFrame, event_type: str) -> DataFrame:
    """Events of one type with the columns of its live table."""
    columns = ["event_ts" if n == "timestamp" else n for n in PAYLOADS[event_type]]
    return events.filter(F.col("event_type") == event_type).select(*columns)


def route_counts(events: DataFrame) -> DataFrame:
    """Events per type; types without a route are counted as `unrouted`."""
    known = F.col("event_type").isin(list(TOPICS))
    return events.groupBy(F.when(known, F.col("event_type")).otherwise("unrouted").alias("route")).agg(
        F.count(F.lit(1)).alias("events")
    )


def without_duplicates(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drops repeated deliveries of one event (same type and key) that arrive within `delay`."""
    timed = events.withColumn("_event_time", as_timestamp("event_ts").cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["event_type", "key"]).drop(
        "_event_time"
    )
