"""Live feed: totals equal batch totals, before and after a restart."""

import json
from collections import Counter

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.sources import testtables
from marketlens.streaming import compaction, live, progress, records


def write_records(spark, sf_dir, path, part, parts):
    encoded = records.encode(testtables.events(spark, sf_dir)).withColumn("n", F.xxhash64("key"))
    encoded.filter(F.pmod("n", F.lit(parts)) == part).drop("n").coalesce(1).write.mode("append").json(path)


def totals(df):
    return {r["metric_key"]: r["metric_value"] for r in df.collect()}


def test_stream_totals_equal_batch_totals_across_a_restart(spark, sf_dir, folder):
    source, table, checkpoint = f"{folder}/in", f"{folder}/totals", f"{folder}/checkpoint"

    def run():
        stream = records.decode(records.file_records(spark, source, max_files=1))
        query = live.start_totals(stream, table, checkpoint)
        query.awaitTermination()
        return totals(live.read_totals(spark, table))

    for part in (0, 1):
        write_records(spark, sf_dir, source, part, 4)
    halfway = run()
    for part in (2, 3):
        write_records(spark, sf_dir, source, part, 4)
    full = run()
    expected = totals(live.running_totals(testtables.events(spark, sf_dir)))
    assert full == expected
    assert set(full) == set(live.METRICS)
    assert all(halfway[k] < full[k] for k in full)
    assert run() == expected


def test_event_tables_hold_each_event_once_after_a_restart(spark, sf_dir, folder):
    source, tables, checkpoint = f"{folder}/in", f"{folder}/tables", f"{folder}/checkpoint"
    events = testtables.events(spark, sf_dir)
    for part in (0, 1):
        write_records(spark, sf_dir, source, part, 2)
        stream = records.decode(records.file_records(spark, source, max_files=1))
        live.start_event_tables(stream, tables, checkpoint).awaitTermination()
    for event_type in live.LIVE_TABLES:
        stored = live.read_events(spark, tables, event_type)
        assert stored.count() == events.filter(F.col("event_type") == event_type).count()
    stored = live.read_events(spark, tables, "payment_processed")
    assert stored.columns == ["order_id", "amount", "result", "event_ts"]


def test_payload_holds_the_fields_of_its_type_only(spark, sf_dir):
    encoded = records.encode(testtables.events(spark, sf_dir))
    row = encoded.filter("topic = 'payments.events'").first()
    assert set(json.loads(row["value"])) == {"event_type", "order_id", "amount", "result", "timestamp"}


def test_unknown_and_malformed_records_are_counted_and_ignored(frame):
    raw = frame(
        "topic string, key string, value string, timestamp timestamp",
        ("t", "1", '{"event_type": "order_created", "order_id": "O", "amount": 5.0, "status": "completed"}', None),
        ("t", "2", '{"event_type": "order_created", "order_id": "P", "amount": 7.0, "status": "cancelled"}', None),
        ("t", "3", '{"event_type": "surprise"}', None),
        ("t", "4", "not json", None),
    )
    events = records.decode(raw)
    assert {r["route"]: r["events"] for r in records.route_counts(events).collect()} == {
        "order_created": 2,
        "unrouted": 2,
    }
    assert totals(live.running_totals(events)) == {"live_revenue_total": 5.0, "live_orders_total": 1.0}


def test_repeated_delivery_is_absorbed_when_asked_for(spark, sf_dir, folder):
    source = f"{folder}/in"
    for _ in range(2):
        write_records(spark, sf_dir, source, 0, 1)
    stream = records.without_duplicates(records.decode(records.file_records(spark, source)))
    live.start_totals(stream, f"{folder}/totals", f"{folder}/checkpoint").awaitTermination()
    expected = totals(live.running_totals(testtables.events(spark, sf_dir)))
    assert totals(live.read_totals(spark, f"{folder}/totals")) == expected


def test_a_new_checkpoint_replaces_nothing(spark, sf_dir, folder):
    source, tables, table = f"{folder}/in", f"{folder}/tables", f"{folder}/totals"
    events = testtables.events(spark, sf_dir)
    write_records(spark, sf_dir, source, 0, 1)

    def run(checkpoint, **options):
        stream = records.decode(records.file_records(spark, source))
        live.start_event_tables(stream, tables, f"{folder}/{checkpoint}-events").awaitTermination()
        live.start_totals(stream, table, f"{folder}/{checkpoint}-totals", **options).awaitTermination()

    run("first")
    with pytest.raises(ValueError, match="another streaming query"):
        run("second")
    write_records(spark, sf_dir, source, 0, 1)
    run("third", replace=True)
    once = totals(live.running_totals(events))
    assert totals(live.read_totals(spark, table)) == {k: 2 * v for k, v in once.items()}
    # the feed was read once, once more, and then twice over
    orders = events.filter("event_type = 'order_created'").count()
    assert live.read_events(spark, tables, "order_created").count() == 4 * orders
    unrouted = events.filter(~F.col("event_type").isin(list(live.LIVE_TABLES))).count()
    assert live.read_unrouted(spark, tables).count() == 4 * unrouted


def test_consumer_lag_from_progress():
    progress = {
        "sources": [
            {
                "endOffset": '{"orders.events": {"0": 5, "1": 7}}',
                "latestOffset": '{"orders.events": {"0": 9, "1": 7}, "payments.events": {"0": 3}}',
            }
        ]
    }
    lag = live.consumer_lag(progress)
    assert (lag["orders.events"], lag["payments.events"], lag["delivery.events"]) == (4, 3, 0)


# --- compaction ----------------------------------------------------------------------------


@pytest.fixture
def tables(spark, sf_dir, folder):
    """Adds batches to event tables, a file each, and lists all their rows."""
    events = records.encode(testtables.events(spark, sf_dir).limit(400)).withColumn("n", F.row_number().over(W.orderBy("key")))
    events = events.persist()

    class Tables:
        path = f"{folder}/tables"

        def add(self, *parts, checkpoint="checkpoint"):
            for part in parts:
                events.where(F.col("n") % 8 == part).drop("n").coalesce(1).write.mode("append").json(f"{folder}/in")
            stream = records.decode(records.file_records(spark, f"{folder}/in", max_files=1))
            live.start_event_tables(stream, self.path, f"{folder}/{checkpoint}").awaitTermination()

        def rows(self):
            return Counter(tuple(map(str, r)) for r in compaction.read(spark, self.path).select("table", "key", "event_ts", "amount").collect())

    yield Tables()
    events.unpersist()


def test_rows_are_the_same_before_during_and_after_compaction(spark, tables):
    tables.add(0, 1, 2)
    before, old_readers = tables.rows(), compaction.read(spark, tables.path)
    first = compaction.compact(spark, tables.path)
    assert first.version == 1 and list(first.upto.values()) == [1] and len(first.folders) == 1
    assert tables.rows() == before and old_readers.count() == sum(before.values())
    tables.add(3, 4)
    grown = tables.rows()
    assert sum(grown.values()) > sum(before.values())
    second = compaction.compact(spark, tables.path)
    assert second.version == 2 and list(second.upto.values()) == [3] and len(second.folders) == 2
    assert tables.rows() == grown
    # nothing is deleted while a reader may still need it
    assert compaction.clean(spark, tables.path) == 0
    assert compaction.clean(spark, tables.path, older_than=0) == 4
    assert tables.rows() == grown and sum(map(len, compaction.batches(spark, tables.path).values())) == 1
    tables.add(5)
    merged = compaction.compact(spark, tables.path, merge_after=2)
    assert len(merged.folders) == 1
    assert compaction.clean(spark, tables.path, older_than=0) == 3
    assert sum(tables.rows().values()) == sum(grown.values()) + 50
    assert compaction.compact(spark, tables.path) == merged


def test_a_compaction_that_dies_before_its_commit_changes_nothing(spark, tables, monkeypatch):
    tables.add(0, 1, 2)
    before = tables.rows()

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, tables.path)
    assert compaction.manifest(spark, tables.path).version == 0 and tables.rows() == before
    assert compaction.compact(spark, tables.path).version == 1
    assert tables.rows() == before
    # the batches, and what the dead one left
    assert compaction.clean(spark, tables.path, older_than=0) == 3
    assert tables.rows() == before


def test_of_two_compactions_one_commits(spark, tables):
    tables.add(0, 1, 2)
    before = tables.rows()
    won = compaction.compact(spark, tables.path)
    with pytest.raises(compaction.CommitConflict):
        compaction._commit(spark, tables.path, compaction.Manifest(1, {"other": 9}, []))
    assert compaction.manifest(spark, tables.path) == won and tables.rows() == before


def test_queries_beside_each_other_are_compacted_each(spark, tables):
    tables.add(0, 1, 2)
    tables.add(checkpoint="second")
    both = tables.rows()
    assert set(both.values()) == {2}
    one, other = compaction.compact(spark, tables.path).upto
    compaction.clean(spark, tables.path, older_than=0)
    assert tables.rows() == both
    parts = [live.read_events(spark, tables.path, "order_created", q).count() for q in (one, other)]
    assert parts[0] == parts[1] and sum(parts) == live.read_events(spark, tables.path, "order_created").count()


def test_days_are_few_files(spark, tables):
    tables.add(0, 1, 2, 3)
    found = compaction.compact(spark, tables.path)
    files = spark.read.parquet(f"{tables.path}/{found.folders[0]}")
    days = files.select("table", "day").distinct().count()
    assert len(files.inputFiles()) == days


# --- event time and progress ---------------------------------------------------------------


def sale(key, time, amount):
    value = {"event_type": "order_created", "order_id": key, "amount": amount, "status": "completed", "timestamp": time}
    return "orders.events", key, json.dumps(value), None


def test_hours_close_once_and_late_events_are_left_out(spark, frame, folder):
    def arrive(*sales):
        frame(records.RECORD_SCHEMA, *[sale(*s) for s in sales]).coalesce(1).write.mode("append").json(f"{folder}/in")

    def run():
        stream = records.decode(records.file_records(spark, f"{folder}/in", max_files=1))
        live.start_revenue_by_hour(stream, f"{folder}/hours", f"{folder}/checkpoint").awaitTermination()
        rows = spark.read.schema("hour timestamp_ntz, revenue double, orders bigint").parquet(f"{folder}/hours").collect()
        return sorted((r.hour.hour, r.revenue, r.orders) for r in rows)

    arrive(("a", "2025-01-01 08:10:00", 1.0), ("b", "2025-01-01 08:50:00", 2.0), ("a", "2025-01-01 08:10:00", 1.0))
    assert run() == []  # the hour may still get events
    arrive(("c", "2025-01-01 09:05:00", 4.0), ("b", "2025-01-01 08:50:00", 2.0), ("d", "2025-01-01 08:59:00", 8.0))
    assert run() == []  # its end is passed, but not by ten minutes
    arrive(("e", "2025-01-01 10:15:00", 16.0))
    closed = [(8, 11.0, 3), (9, 4.0, 1)]
    assert run() == closed
    arrive(("f", "2025-01-01 08:30:00", 32.0), ("b", "2025-01-01 08:50:00", 2.0), ("g", "2025-01-01 10:20:00", 64.0))
    assert run() == closed  # too late
    arrive(("h", "2025-01-01 12:00:00", 128.0))
    assert run() == [*closed, (10, 80.0, 2)]


def test_progress_has_a_row_per_batch_over_a_restart(spark, sf_dir, folder):
    def run():
        with progress.ProgressTable(spark, f"{folder}/progress") as table:
            stream = records.decode(records.file_records(spark, f"{folder}/in", max_files=1))
            live.start_totals(stream, f"{folder}/totals", f"{folder}/checkpoint").awaitTermination()
        return {r.batch_id: r.input_rows for r in table.read().collect()}

    for part in (0, 1):
        write_records(spark, sf_dir, f"{folder}/in", part, 3)
    first = run()
    assert list(sorted(first)) == [0, 1]
    write_records(spark, sf_dir, f"{folder}/in", 2, 3)
    both = run()
    assert {b: both[b] for b in first} == first and sum(both.values()) == testtables.events(spark, sf_dir).count()


def test_progress_row_holds_lag_and_late_rows():
    made = progress.row(
        {
            "id": "q", "runId": "r", "batchId": 3, "timestamp": "t", "numInputRows": 7,
            "stateOperators": [{"numRowsTotal": 4, "numRowsDroppedByWatermark": 1}, {"numRowsTotal": 2}],
            "sources": [{"endOffset": '{"orders.events": {"0": 5}}', "latestOffset": '{"orders.events": {"0": 9}}'}],
        }
    )
    assert made[:8] == ("q", "r", 3, "t", 7, 6, 1, None) and made[8]["orders.events"] == 4
