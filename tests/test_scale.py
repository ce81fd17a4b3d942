"""Work of the queries over the tables that must grow with them only."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from marketlens.plans import registry, warehouse
from marketlens.plans.warehouse import ScreenedOnce, Warehouse
from marketlens.sources import testtables

EVENT = (
    "event_id bigint, event_type string, order_id string, customer_id bigint, product_id bigint, warehouse_id string, "
    "quantity int, amount double, status string, result string, partner string, sla_breach boolean, delta_qty int, "
    "event_ts timestamp_ntz"
)


@pytest.fixture
def sources(frame):
    day = "2024-01-02 00:00:00"
    orders = [
        ("O1", 1, 1, "W1", day, 2, 10.0, "completed"),
        ("O1", 1, 1, "W1", "2024-01-01 00:00:00", 2, 9.0, "completed"),
        ("O2", 9, 1, "W1", day, 3, 10.0, "completed"),
        ("O3", 1, 9, "W1", day, 1, 10.0, "completed"),
        ("O4", 1, 2, "W1", day, 1, 10.0, "completed"),
        ("O5", 2, 1, "W2", day, 1, -10.0, "completed"),
        ("O6", 2, 1, "W2", "never", 1, 10.0, "completed"),
        ("O7", None, 1, "W2", day, 1, 10.0, "completed"),
        ("O8", 2, 3, "W2", day, 6, 5.0, "pending"),
    ]
    return {
        "customers": frame(
            "customer_id bigint, city string, state string, segment string, registration_date date",
            (1, "a", "b", "c", None), (1, "a", "b", "c", None), (2, "a", "b", "c", None), (None, "a", "b", "c", None),
        ),
        "products": frame(
            "product_id bigint, category string, brand string, cost double, selling_price double, supplier_id string",
            (1, "a", "b", 1.5, 2.0, "S"), (2, "a", "b", 1.0, 0.0, "S"), (3, "a", "b", None, 2.0, "S"),
        ),
        "orders": frame(
            "order_id string, customer_id bigint, product_id bigint, warehouse_id string, timestamp string, "
            "quantity int, amount double, status string", *orders,
        ),
        "delivery": frame(
            "order_id string, partner string, pickup_time timestamp_ntz, expected_delivery timestamp_ntz, "
            "actual_delivery timestamp_ntz, status string",
            *[(o, "P", None, None, None, "delivered") for o in ("O1", "O1", "O2", "O8", "O99")],
        ),
    }


def _rows(df):
    return sorted(map(str, df.collect()))


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_stored_orders_are_checked_alike_with_few_and_many_orphans(sources, monkeypatch, limit):
    monkeypatch.setattr("marketlens.operators.quality.BROADCAST_IDS", limit)
    monkeypatch.setattr(warehouse, "BROADCAST_PRODUCTS", limit)
    plain, once = Warehouse(sources), ScreenedOnce(sources)
    assert _rows(once.screened("orders")) == _rows(plain.screened("orders"))
    for name in ("fact_orders", "fact_delivery", "dim_date"):
        assert _rows(getattr(once, name)) == _rows(getattr(plain, name))


def test_stored_orders_are_not_shuffled_to_be_checked(spark, sources):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(ScreenedOnce(sources).silver("orders"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan


def test_a_reader_without_costs_joins_no_product(spark, sources):
    facts = ScreenedOnce(sources).fact_orders
    assert "costs-" not in _plan(facts.groupBy("status").agg(F.sum("amount")))
    assert "costs-" in _plan(facts.groupBy("status").agg(F.sum("cost_total")))


@pytest.mark.parametrize("name", ["kpi_snapshot", "executive_summary"])
def test_delivery_figures_join_no_orders(spark, sf_dir, name):
    plan = _plan(queries()[name](spark, sf_dir))
    assert not re.search(r"(Join|Outer).*order_id", plan)


def test_deliveries_still_know_their_warehouse(sources):
    found = {r["order_key"]: r["warehouse_key"] for r in Warehouse(sources).fact_delivery.collect()}
    assert found == {"O1": "W1", "O2": None, "O8": "W2", "O99": None}


@pytest.mark.parametrize("name", ["expectation_report", "quality_assertions", "alerts_listing"])
def test_orders_are_screened_once(spark, sf_dir, monkeypatch, name):
    names, kept = [], warehouse.stored
    monkeypatch.setattr(warehouse, "stored", lambda df, n: (names.append(n), kept(df, n))[1])
    queries()[name](spark, sf_dir)
    assert names.count("kept-orders") == 1


def test_source_files_are_small_and_compressed(spark, frame, sources, monkeypatch):
    monkeypatch.setattr(testtables, "TestSources", lambda *_: sources)
    monkeypatch.setitem(registry._CSV, "maxRecordsPerFile", 2)
    folder = registry._write_csv(spark, "none")
    files = glob.glob(f"{folder.removeprefix('file:')}/orders.csv/1/*.csv*")
    assert len(files) >= 4 and all(f.endswith(".csv.gz") for f in files)
    read = registry._read_csv(spark, folder).sources["orders"]
    wanted = sources["orders"].select([F.col(c).cast("string") for c in sources["orders"].columns])
    assert _rows(read.select(*wanted.columns)) == _rows(wanted)


def test_later_copies_are_taken_from_the_first_file(spark, sources, monkeypatch):
    monkeypatch.setattr(testtables, "TestSources", lambda *_: sources)
    monkeypatch.setattr(testtables, "orders", lambda *_: sources["orders"])
    seen, write = [], registry._again
    monkeypatch.setattr(registry, "_again", lambda s, f, n, df: (seen.append(df), write(s, f, n, df)))
    found = registry.silver_orders_by_arrival(spark, "none")
    assert "Window" not in _plan(seen[0])
    assert {r["order_id"] for r in seen[0].collect()} == {"O2", "O8"}
    assert {(r["order_id"], r["amount"]) for r in found.collect()} == {("O1", 10.0), ("O8", 5.0)}


def test_feed_files_are_written_from_their_own_rows(spark, frame, folder, monkeypatch):
    rows = [(i, "order_created", f"E{i}", 1, 1, "W", 1, 1.0, "completed", None, None, None, None, None) for i in range(40)]
    rows.append((None, "order_created", "E", 1, 1, "W", 1, 1.0, "completed", None, None, None, None, None))
    monkeypatch.setattr(testtables, "events", lambda *_: frame(EVENT, *rows))
    monkeypatch.setattr(registry, "_FILE_RECORDS", 8)
    read, parquet = [], type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **o: (read.extend(p), parquet(self, *p, **o))[1])
    registry._feed(spark, "none", f"{folder}/feed", repeated=True)
    assert any(p.endswith("feed-dealt") for p in read)
    found = {}
    for file in glob.glob(f"{folder}/feed/part-*"):
        keys = sorted(int(r["key"][1:]) for r in spark.read.json(file).collect())
        found[keys[-1]] = keys
    fifths = lambda ids: [i for i in ids if i % 5 == 0]
    expected = [sorted([*range(n * 8, n * 8 + 8), *fifths(range(n * 8, n * 8 + 8))]) for n in range(5)]
    expected[4] = sorted(expected[4] + [0, 7])
    assert [found[k] for k in sorted(found)] == expected


def test_only_files_that_are_read_are_written(spark, sources, frame, monkeypatch):
    stock = "product_id bigint, warehouse_id string, available_qty int, reserved_qty int, reorder_level int, updated_at timestamp_ntz"
    held = sources | {"inventory": frame(stock, (1, "W1", 5, 1, 2, None), (1, "W1", 7, 3, 1, None), (2, "W1", 4, 0, 1, None))}
    monkeypatch.setattr(testtables, "TestSources", lambda *_: held)
    monkeypatch.setattr(testtables, "inventory", lambda *_: held["inventory"])
    folders, read = [], registry._read_csv
    monkeypatch.setattr(registry, "_read_csv", lambda s, f, *a: (folders.append(f), read(s, f, *a))[1])
    found = registry.silver_inventory_by_arrival(spark, "none").collect()
    assert sorted((str(r["product_id"]), r["available_qty"], r["reserved_qty"]) for r in found) == [("1", 7, 1), ("2", 4, 0)]
    assert {str(r["updated_at"])[:4] for r in found} == {"1990"}
    assert glob.glob(f"{folders[0].removeprefix('file:')}/*.csv") == [f"{folders[0].removeprefix('file:')}/inventory.csv"]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_parents_that_are_broadcast_give_the_same_facts(sources, monkeypatch, limit):
    monkeypatch.setattr(warehouse, "BROADCAST_PARENTS", limit)
    monkeypatch.setattr(warehouse, "BROADCAST_PRODUCTS", limit)
    plain, once = Warehouse(sources), warehouse.ParentsOnce(sources)
    assert _rows(once.screened("orders")) == _rows(plain.screened("orders"))
    for name in ("fact_orders", "fact_delivery", "dim_date", "dim_customer"):
        assert _rows(getattr(once, name)) == _rows(getattr(plain, name))


@pytest.mark.parametrize("name", ["kpi_snapshot", "kpis_of_domain", "executive_summary"])
def test_kpis_shuffle_no_orders_to_check_them(spark, sf_dir, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "known-customers-" in plan and "known-products-" in plan
    assert not re.search(r"SortMergeJoin \[(customer|product)_id", plan)
