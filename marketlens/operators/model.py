"""Star schema: dimensions, facts and the enriched intermediates.

Two variants exist side by side. The plain names are built from the silver layer and
feed every other job. The `*_staged` names are built from staging and differ in the
points named in their docstrings.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.columns import (
    boundary_hours,
    date_key,
    elapsed_hours,
    is_true,
    is_weekend,
    ratio,
    round_even,
    round_up,
)
from marketlens.operators.lookup import lookup

KEY_NAMES = {
    "customer_id": "customer_key",
    "product_id": "product_key",
    "warehouse_id": "warehouse_key",
    "order_id": "order_key",
}


def with_keys(df: DataFrame) -> DataFrame:
    """Business ids renamed to dimension keys."""
    return df.withColumnsRenamed({c: KEY_NAMES[c] for c in df.columns if c in KEY_NAMES})


# --- dimensions ---------------------------------------------------------------------


def dim_customer(customers: DataFrame) -> DataFrame:
    return with_keys(customers)


def dim_product(products: DataFrame) -> DataFrame:
    """Margin share of the price, four decimals, halves to even."""
    share = ratio(F.col("selling_price") - F.col("cost"), F.col("selling_price"))
    return with_keys(products).withColumn("margin_pct", round_even(share, 4))


def dim_product_staged(products: DataFrame) -> DataFrame:
    """As `dim_product`, halves rounded up."""
    share = ratio(F.col("selling_price") - F.col("cost"), F.col("selling_price"))
    return with_keys(products).withColumn("margin_pct", round_up(share, 4))


def dim_warehouse(inventory: DataFrame) -> DataFrame:
    """Warehouses that hold stock; one seen only in orders has no row."""
    return with_keys(inventory.select("warehouse_id").distinct())


def _calendar(bounds: DataFrame) -> DataFrame:
    day = F.col("full_date")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"))
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: date = date(2025, 1, 1), end: date = date(2026, 12, 31)) -> DataFrame:
    """One row per calendar day of a fixed range."""
    return _calendar(spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day")))


def dim_date_spanning(orders: DataFrame, ts: str = "order_ts") -> DataFrame:
    """One row per calendar day from the first to the last order, gaps included."""
    day = F.to_date(ts)
    return _calendar(orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).na.drop())


# --- orders -------------------------------------------------------------------------

# Columns of the facts.
_FACT_ORDERS = [
    "order_key",
    "customer_key",
    "product_key",
    "warehouse_key",
    "date_key",
    "timestamp",
    "quantity",
    "amount",
    "cost_total",
    "margin_amount",
    "status",
]


def fact_orders(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Cost of an unknown product counts as zero; margin rounded to two decimals."""
    costs = products.select("product_id", F.col("cost").alias("unit_cost"))
    unit_cost = F.coalesce(F.col("unit_cost"), F.lit(0.0))
    costed = (
        lookup(orders, costs, "product_id")
        .withColumn("cost_total", unit_cost * F.col("quantity"))
        .withColumn("margin_amount", round_even(F.col("amount") - F.col("cost_total"), 2))
        .withColumn("date_key", date_key("timestamp"))
    )
    return with_keys(costed).select(*_FACT_ORDERS)


def orders_enriched(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Staged orders with product and customer attributes; unmatched attributes stay null."""
    product = products.select("product_id", "category", "brand", F.col("cost").alias("unit_cost"))
    customer = customers.select(
        "customer_id", F.col("segment").alias("customer_segment"), F.col("city").alias("customer_city")
    )
    joined = lookup(lookup(orders, product, "product_id"), customer, "customer_id")
    cost_total = F.col("unit_cost") * F.col("quantity")
    return joined.select(
        *orders.columns,
        "category",
        "brand",
        "unit_cost",
        cost_total.alias("cost_total"),
        (F.col("amount") - cost_total).alias("margin_amount"),
        "customer_segment",
        "customer_city",
    )


def fact_orders_staged(enriched: DataFrame) -> DataFrame:
    """As `fact_orders`, but an unknown cost stays null and the margin is not rounded."""
    keyed = with_keys(enriched).withColumn("date_key", date_key("order_ts"))
    return keyed.select(*["order_ts" if c == "timestamp" else c for c in _FACT_ORDERS])


# --- inventory ----------------------------------------------------------------------


def inventory_position(inventory: DataFrame) -> DataFrame:
    stock = F.col("available_qty") - F.col("reserved_qty")
    return inventory.withColumns(
        {"stock_position": stock, "below_reorder_level": is_true(stock < F.col("reorder_level"))}
    )


def fact_inventory(inventory: DataFrame) -> DataFrame:
    """Also serves the staged variant: the two differ in their input only."""
    positions = inventory_position(inventory).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    return with_keys(positions).withColumn("date_key", date_key("updated_at"))


# --- delivery -----------------------------------------------------------------------


def _fact_delivery(delivery: DataFrame, orders: DataFrame, hours: Column) -> DataFrame:
    """Both inputs hold one row per order, so the join cannot be skewed."""
    warehouse = orders.select("order_id", "warehouse_id")
    return delivery_facts(delivery.join(warehouse, "order_id", "left"), hours)


def delivery_facts(delivery: DataFrame, hours: Column | None = None) -> DataFrame:
    """Deliveries that know the warehouse of their order; `hours` are elapsed hours unless given."""
    hours = elapsed_hours("pickup_time", "actual_delivery") if hours is None else hours
    return with_keys(delivery).select(
        "order_key",
        "warehouse_key",
        "partner",
        date_key("pickup_time").alias("date_key"),
        "pickup_time",
        "expected_delivery",
        "actual_delivery",
        hours.alias("delivery_hours"),
        is_true(F.col("actual_delivery") > F.col("expected_delivery")).alias("sla_breached"),
        "status",
    )


def fact_delivery(delivery: DataFrame, orders: DataFrame) -> DataFrame:
    """Duration as elapsed hours with two decimals."""
    return _fact_delivery(delivery, orders, elapsed_hours("pickup_time", "actual_delivery"))


def fact_delivery_staged(delivery: DataFrame, orders: DataFrame) -> DataFrame:
    """Duration as the number of full-hour marks passed."""
    return _fact_delivery(delivery, orders, boundary_hours("pickup_time", "actual_delivery"))


# --- marketing ----------------------------------------------------------------------

# Columns of the fact.
_FACT_MARKETING = [
    "campaign_id",
    "date_key",
    "channel",
    "spend",
    "impressions",
    "clicks",
    "conversions",
    "ctr",
    "conversion_rate",
    "cac",
]


def fact_marketing(marketing: DataFrame) -> DataFrame:
    """Ratios are null on a zero denominator; halves to even."""
    return marketing.withColumns(
        {
            "date_key": date_key(F.col("date").cast("date")),
            "ctr": round_even(ratio(F.col("clicks"), F.col("impressions")), 4),
            "conversion_rate": round_even(ratio(F.col("conversions"), F.col("clicks")), 4),
            "cac": round_even(ratio(F.col("spend"), F.col("conversions")), 2),
        }
    ).select(*_FACT_MARKETING)


def fact_marketing_staged(marketing: DataFrame) -> DataFrame:
    """Rates are 0 on a zero denominator, cost per conversion null; halves rounded up."""

    def guarded(top: str, bottom: str, digits: int) -> Column:
        value = round_up(ratio(F.col(top), F.col(bottom)), digits)
        return F.when(F.col(bottom) > 0, value)

    return marketing.withColumns(
        {
            "date_key": date_key("campaign_date"),
            "ctr": F.coalesce(guarded("clicks", "impressions", 4), F.lit(0.0)),
            "conversion_rate": F.coalesce(guarded("conversions", "clicks", 4), F.lit(0.0)),
            "cac": guarded("spend", "conversions", 2),
        }
    ).select(*_FACT_MARKETING)
