"""Values of source files that cannot be read."""

import pytest

from marketlens.operators import staging
from marketlens.sources import quarantine
from marketlens.sources.files import read_source

HEADER = "order_id,customer_id,product_id,warehouse_id,timestamp,quantity,amount,status\n"


@pytest.fixture
def orders(spark, folder, tmp_path):
    def write(*lines):
        (tmp_path / "orders.csv").write_text(HEADER + "".join(f"{line}\n" for line in lines))
        return read_source(spark, "orders", str(tmp_path / "orders.csv"))

    return write


def test_what_cannot_be_read_is_kept_with_its_place(spark, orders, folder):
    raw = orders(
        "a,c,p,w,2025-01-01 08:00:00,1,12.5x,completed",
        "b,c,p,w,soon,two,3,completed",
        "c,c,p,w,,,,completed",
        "d,c,p,w,2025-01-01,4,5.5,completed",
    )
    found = sorted(tuple(r)[:5] for r in quarantine.unreadable_values("orders", raw).collect())
    assert found == [
        ("orders", "a", "amount", "double", "12.5x"),
        ("orders", "b", "quantity", "int", "two"),
        ("orders", "b", "timestamp", "timestamp_ntz", "soon"),
    ]
    with pytest.raises(quarantine.UnreadableSource, match="orders: 3 values cannot be read.*12.5x|soon|two"):
        quarantine.stage_strictly("orders", raw, folder)
    stored = spark.read.parquet(folder)
    assert stored.count() == 3 and all(r.file.endswith("orders.csv") and r.row is not None for r in stored.collect())


def test_readable_sources_are_staged(spark, orders, folder):
    raw = orders("a,c,p,w,2025-01-01 08:00:00,1,12.5,completed", "a,c,p,w,2025-01-02 08:00:00,2,13.5,completed")
    staged = quarantine.stage_strictly("orders", raw, folder)
    assert [(r.order_id, r.amount) for r in staged.collect()] == [("a", 13.5)]
    assert spark.read.parquet(folder).count() == 0


@pytest.mark.parametrize("source", sorted(staging.TYPES))
def test_typed_sources_and_empty_ones_hold_nothing_unreadable(spark, source):
    columns = ", ".join(f"{c} {t}" for c, t in staging.TYPES[source].items() if c != staging.KEYS[source])
    raw = spark.createDataFrame([], f"{staging.KEYS[source]} string, {columns}")
    assert quarantine.unreadable_values(source, raw).count() == 0
    text = spark.createDataFrame([], f"{staging.KEYS[source]} string, " + ", ".join(f"{c} string" for c in staging.TYPES[source]))
    assert quarantine.unreadable_values(source, text).columns == ["source", "key", "column_name", "declared_type", "value"]
