"""Staging: typed sources with the latest copy per key.

The second variant of the cleaned sources. It differs from the silver layer in that
copies are ranked by a business column, nothing is checked against other sources,
and null quantities or prices do not pass the range filters. Filters run after
deduplication, so a bad latest copy removes its key.

Types are cast strictly: a value that cannot be converted stops the job. Pass
`strict=False` to turn it into null instead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.dedup import keep_one


# Columns that are cast, and the first column of each business key. The end of a support
# ticket is missing here: open tickets carry blanks, so it is always cast leniently.
TYPES = {
    "orders": {"timestamp": "timestamp_ntz", "quantity": "int", "amount": "double"},
    "customers": {"registration_date": "date"},
    "products": {"cost": "double", "selling_price": "double"},
    "inventory": {"available_qty": "int", "reserved_qty": "int", "reorder_level": "int", "updated_at": "timestamp_ntz"},
    "delivery": dict.fromkeys(("pickup_time", "expected_delivery", "actual_delivery"), "timestamp_ntz"),
    "support": {"created_at": "timestamp_ntz"},
    "marketing": {"date": "date", "spend": "double", "impressions": "int", "clicks": "int", "conversions": "int"},
}
KEYS = {
    "orders": "order_id", "customers": "customer_id", "products": "product_id", "inventory": "product_id",
    "delivery": "order_id", "support": "ticket_id", "marketing": "campaign_id",
}


def _typed(df: DataFrame, types: Mapping[str, str], strict: bool) -> DataFrame:
    """`df` with the given columns cast; a null in strict mode was a null before."""
    convert = "cast" if strict else "try_cast"
    return df.selectExpr(
        *[f"{convert}(`{c}` as {types[c]}) as `{c}`" if c in types else f"`{c}`" for c in df.columns]
    )


def _largest(raw: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The copy with the largest `number`, which may still be text."""
    ranked = raw.withColumn("_rank", F.col(number).try_cast("double"))
    return keep_one(ranked, keys, ["_rank"]).drop("_rank")


def stg_orders(raw: DataFrame, strict: bool = True) -> DataFrame:
    latest = keep_one(raw.filter(F.col("order_id").isNotNull()), ["order_id"], ["timestamp"])
    return (
        _typed(latest, TYPES["orders"], strict)
        .filter("amount >= 0")
        .withColumnRenamed("timestamp", "order_ts")
        .select("order_id", "customer_id", "product_id", "warehouse_id", "order_ts", "quantity", "amount", "status")
    )


def stg_customers(raw: DataFrame, strict: bool = True) -> DataFrame:
    latest = keep_one(raw.filter(F.col("customer_id").isNotNull()), ["customer_id"], ["registration_date"])
    return _typed(latest, TYPES["customers"], strict).select(
        "customer_id", "city", "state", "segment", "registration_date"
    )


def stg_products(raw: DataFrame, strict: bool = True) -> DataFrame:
    latest = _largest(raw.filter(F.col("product_id").isNotNull()), ["product_id"], "selling_price")
    return (
        _typed(latest, TYPES["products"], strict)
        .filter("selling_price > 0")
        .select("product_id", "category", "brand", "cost", "selling_price", "supplier_id")
    )


def stg_inventory(raw: DataFrame, strict: bool = True) -> DataFrame:
    latest = keep_one(raw, ["product_id", "warehouse_id"], ["updated_at"])
    return (
        _typed(latest, TYPES["inventory"], strict)
        .filter("available_qty >= 0 and reserved_qty >= 0")
        .select("warehouse_id", "product_id", "available_qty", "reserved_qty", "reorder_level", "updated_at")
    )


def stg_delivery(raw: DataFrame, strict: bool = True) -> DataFrame:
    latest = keep_one(raw.filter(F.col("order_id").isNotNull()), ["order_id"], ["actual_delivery"])
    return _typed(latest, TYPES["delivery"], strict).select(
        "order_id", "partner", "pickup_time", "expected_delivery", "actual_delivery", "status"
    )


def stg_support(raw: DataFrame, strict: bool = True) -> DataFrame:
    """`resolved_at` is always cast leniently: open tickets carry blanks."""
    latest = keep_one(raw.filter(F.col("ticket_id").isNotNull()), ["ticket_id"], ["created_at"])
    typed = _typed(latest, TYPES["support"], strict)
    columns = ["ticket_id", "customer_id", "order_id", "issue_type", "priority", "created_at"]
    return typed.select(
        *[c for c in columns if c in typed.columns],
        F.col("resolved_at").try_cast("timestamp_ntz").alias("resolved_at"),
    )


def stg_marketing(raw: DataFrame, strict: bool = True) -> DataFrame:
    latest = _largest(raw, ["date", "channel", "campaign_id"], "spend")
    return (
        _typed(latest, TYPES["marketing"], strict)
        .withColumnRenamed("date", "campaign_date")
        .select("campaign_id", "campaign_date", "channel", "spend", "impressions", "clicks", "conversions")
    )
