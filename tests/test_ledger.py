"""The ledger of a run's stages; checks are counted while tables are written."""

from collections import Counter

import pytest

from marketlens.operators import expectations, quality
from marketlens.plans.ledger import Ledger, fingerprint
from marketlens.plans.warehouse import Warehouse
from marketlens.session import stored


def rows(df):
    return Counter(map(str, df.collect()))


def test_a_changed_stage_undoes_what_follows(spark, folder):
    ran = []
    stages = lambda told: [("a", "", lambda: ran.append("a")), ("b", told, lambda: ran.append("b")), ("c", "", lambda: ran.append("c"))]
    ledger = Ledger(spark, folder)
    assert ledger.run("x", stages("1")) == ["a", "b", "c"]
    assert ledger.run("x", stages("1")) == []
    assert ledger.run("x", stages("2")) == ["b", "c"]
    assert ledger.run("y", stages("2")) == ["a", "b", "c"]
    with pytest.raises(ZeroDivisionError):
        ledger.run("z", [stages("2")[0], ("b", "2", lambda: 1 / 0), stages("2")[2]])
    assert ledger.run("z", stages("2")) == ["b", "c"]


def test_frames_without_files_are_never_skipped(spark, frame):
    table = {"t": frame("a int", (1,))}
    assert fingerprint(spark, table) != fingerprint(spark, table)


# --- checks counted by the write -----------------------------------------------------------


def test_quality_report_is_counted_by_the_write(spark, sf_dir):
    w = Warehouse.over_test_tables(spark, sf_dir)
    plans = {}

    def store(name, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    kept, report = quality.store_screened(w.sources, store)
    assert rows(report.drop("checked_at")) == rows(w.dq_report.drop("checked_at"))
    assert set(kept) == set(w.sources)
    assert all(plan.count("CollectMetrics") == 2 for plan in plans.values())
    assert plans["orders"].count("lineitem") <= 2 and plans["inventory"].count("Scan parquet") == 1


def test_declared_checks_are_counted_by_the_write(spark, frame):
    tables = {name: frame(f"{c} string, x int", ("a", 1), ("a", 2), (None, 3)) for name, c in expectations.UNIQUE.items()}
    tables["fact_orders"] = frame("order_key string, customer_key string, product_key string, amount double", ("a", "a", "z", None), (None, "q", None, 1.0))
    tables["fact_inventory"] = frame("warehouse_key string, product_key string", ("w", None))
    tables["fact_marketing"] = frame("campaign_id string", (None,), ("c",))
    kept, report = expectations.store_checked(tables, lambda name, df: stored(df, name))
    assert rows(report.select("table_name", "column_name", "check_name", "failures")) == rows(
        expectations.schema_checks(tables).select("table_name", "column_name", "check_name", "failures")
    )
    assert set(kept) == set(tables)
