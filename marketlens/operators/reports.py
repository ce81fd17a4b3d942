"""Dashboard queries as functions of the stored tables.

Every ordering that is followed by a limit ends in a unique key, so the rows
returned do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import money, money_mean, money_sum, percent, percent_true, ratio
from marketlens.operators.kpis import completed_orders

# The domains of the KPI snapshot.
DOMAINS = ["sales", "customers", "inventory", "delivery", "marketing"]

# --- KPI pages ----------------------------------------------------------------------


def all_kpis(snapshot: DataFrame) -> DataFrame:
    return snapshot.orderBy("domain", "metric", "dims")


def kpis_by_domain(snapshot: DataFrame, domain: str) -> DataFrame:
    """KPI rows of one domain; an unknown domain is an error."""
    if domain not in DOMAINS:
        raise LookupError(f"no KPIs found for domain {domain!r}")
    return snapshot.filter(F.col("domain") == domain).orderBy("metric", "dims")


# --- sales --------------------------------------------------------------------------


def revenue_daily(fact_orders: DataFrame, limit: int = 90) -> DataFrame:
    """The latest `limit` days with sales, oldest first."""
    days = (
        completed_orders(fact_orders)
        .groupBy(F.to_date("timestamp").alias("day"))
        .agg(money_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )
    return days.orderBy(F.col("day").desc()).limit(limit).orderBy("day")


def revenue_by_category(fact_orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Orders are reduced to products before the join; the join has one row per product."""
    per_product = (
        completed_orders(fact_orders)
        .groupBy("product_key")
        .agg(
            F.sum(money("amount")).alias("revenue"),
            F.sum("quantity").alias("units"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    return (
        per_product.join(dim_product.select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(
            F.sum("revenue").cast("double").alias("revenue"),
            F.sum("units").alias("units"),
            F.sum("orders").alias("orders"),
        )
        .orderBy(F.col("revenue").desc(), "category")
    )


def revenue_by_warehouse(fact_orders: DataFrame) -> DataFrame:
    return (
        completed_orders(fact_orders)
        .groupBy(F.col("warehouse_key").alias("warehouse"))
        .agg(money_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy(F.col("revenue").desc(), "warehouse")
    )


def recent_orders(fact_orders: DataFrame, limit: int = 50, status: str | None = None) -> DataFrame:
    rows = fact_orders.filter(F.col("status") == status) if status else fact_orders
    return rows.orderBy(F.col("timestamp").desc(), "order_key").limit(limit)


# --- inventory ----------------------------------------------------------------------


def inventory_status(fact_inventory: DataFrame, limit: int = 200) -> DataFrame:
    return fact_inventory.orderBy(
        F.col("below_reorder_level").desc(), "stock_position", "warehouse_key", "product_key"
    ).limit(limit)


def at_risk_items(fact_inventory: DataFrame) -> DataFrame:
    return fact_inventory.filter("below_reorder_level").orderBy("stock_position", "warehouse_key", "product_key")


def inventory_by_warehouse(fact_inventory: DataFrame) -> DataFrame:
    return fact_inventory.groupBy("warehouse_key").agg(
        F.count(F.lit(1)).alias("sku_count"),
        F.count_if("below_reorder_level").alias("skus_below_reorder"),
        ratio(F.sum("stock_position"), F.count("stock_position")).alias("avg_stock_position"),
    )


# --- customers ----------------------------------------------------------------------


def list_customers(dim_customer: DataFrame, limit: int = 50) -> DataFrame:
    return dim_customer.orderBy("customer_key").limit(limit)


def _per_customer_attribute(fact_orders: DataFrame, dim_customer: DataFrame, attribute: str) -> DataFrame:
    """Customers, revenue and orders per customer attribute. Orders are reduced to
    customers first: customers are then counted as rows and the join cannot be skewed."""
    per_customer = (
        completed_orders(fact_orders)
        .groupBy("customer_key")
        .agg(F.sum(money("amount")).alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )
    return (
        per_customer.join(dim_customer.select("customer_key", attribute), "customer_key")
        .groupBy(attribute)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("revenue").cast("double").alias("revenue"),
            F.sum("orders").alias("orders"),
        )
    )


def customers_by_segment(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return _per_customer_attribute(fact_orders, dim_customer, "segment").orderBy(F.col("revenue").desc(), "segment")


def top_cities(fact_orders: DataFrame, dim_customer: DataFrame, limit: int = 15) -> DataFrame:
    cities = _per_customer_attribute(fact_orders, dim_customer, "city").drop("orders")
    return cities.orderBy(F.col("revenue").desc(), "city").limit(limit)


# --- delivery -----------------------------------------------------------------------


def partner_performance(fact_delivery: DataFrame) -> DataFrame:
    return (
        fact_delivery.groupBy("partner")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            money_mean("delivery_hours").alias("avg_delivery_hours"),
            percent_true(F.col("sla_breached")).alias("sla_breach_pct"),
        )
        .orderBy("sla_breach_pct", "partner")
    )


def sla_trend(fact_delivery: DataFrame) -> DataFrame:
    return (
        fact_delivery.groupBy(F.to_date("pickup_time").alias("day"))
        .agg(percent_true(F.col("sla_breached")).alias("sla_breach_pct"), F.count(F.lit(1)).alias("deliveries"))
        .orderBy("day")
    )


def recent_deliveries(fact_delivery: DataFrame, limit: int = 50) -> DataFrame:
    return fact_delivery.orderBy(F.col("pickup_time").desc(), "order_key").limit(limit)


# --- marketing ----------------------------------------------------------------------


def marketing_by_channel(fact_marketing: DataFrame) -> DataFrame:
    sums = fact_marketing.groupBy("channel").agg(
        money_sum("spend").alias("spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
    )
    return sums.withColumns(
        {
            "ctr_pct": percent(F.col("clicks"), F.col("impressions")),
            "conversion_rate_pct": percent(F.col("conversions"), F.col("clicks")),
            "cac": ratio(F.col("spend"), F.col("conversions")),
        }
    ).orderBy(F.col("spend").desc(), "channel")


def marketing_daily(fact_marketing: DataFrame, limit: int = 90) -> DataFrame:
    days = fact_marketing.groupBy("date_key").agg(
        money_sum("spend").alias("spend"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
    )
    return days.orderBy(F.col("date_key").desc()).limit(limit).orderBy("date_key")


# --- alerts, live feed, monitoring --------------------------------------------------


def list_alerts(alerts: DataFrame, status: str | None = None, severity: str | None = None) -> DataFrame:
    rows = alerts.filter(F.col("status") == status) if status else alerts
    rows = rows.filter(F.col("severity") == severity) if severity else rows
    order = [c for c in ("created_at",) if c in rows.columns]
    return rows.orderBy(*[F.col(c).desc() for c in order], "rule", "entity")


def live_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("metric_key")


def recent_live_orders(live_orders: DataFrame, limit: int = 25) -> DataFrame:
    return live_orders.orderBy(F.col("event_ts").desc(), "order_id").limit(limit)


def pipeline_status(dq_report: DataFrame) -> DataFrame:
    return dq_report.orderBy(F.col("checked_at").desc(), "table_name", "rule")


def operations_summary(fact_inventory: DataFrame, fact_delivery: DataFrame, alerts: DataFrame) -> DataFrame:
    """Items below reorder level, partners, open alerts, worst breach share in one row."""
    partners = fact_delivery.groupBy("partner").agg(percent_true(F.col("sla_breached")).alias("pct"))
    parts = [
        fact_inventory.agg(F.count_if("below_reorder_level").alias("skus_below_reorder")),
        partners.agg(F.count(F.lit(1)).alias("delivery_partners"), F.max("pct").alias("worst_partner_breach_pct")),
        alerts.agg(F.count_if(F.col("status") == "OPEN").alias("open_alerts")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


# --- forecast and anomalies ---------------------------------------------------------


def forecast_listing(forecast: DataFrame) -> DataFrame:
    return forecast.orderBy("forecast_day")


def flagged_anomalies(report: DataFrame, limit: int = 60) -> DataFrame:
    return report.filter("is_anomaly").orderBy(F.col("day").desc()).limit(limit)


def anomaly_timeline(report: DataFrame, limit: int = 120) -> DataFrame:
    return report.orderBy(F.col("day").desc()).limit(limit)
