"""KPI rows `(domain, metric, value, dims)` over five domains.

Each fact is first reduced to a small table (per month, customer, product, partner
or channel); the figures are read from that. Joins with dimensions happen after the
reduction, one row per key on both sides, so no hot key reaches a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.functions.columns import money, or_zero, ratio

COMPLETED = "completed"

# The metrics shown on the executive summary.
SUMMARY_METRICS = [
    "total_revenue",
    "total_orders",
    "average_order_value",
    "on_time_delivery_pct",
    "stockout_risk_item_count",
    "estimated_roas",
    "total_customers",
    "repeat_customer_rate_pct",
]


def completed_orders(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.filter(F.col("status") == COMPLETED)


def metric_rows(one_row: DataFrame, domain: str) -> DataFrame:
    """A one-row table of figures as one row per figure, named after its column."""
    entries = ", ".join(f"struct('{c}' as metric, cast(`{c}` as double) as value)" for c in one_row.columns)
    return one_row.selectExpr(f"'{domain}' as domain", f"inline(array({entries}))").selectExpr("*", "'' as dims")


def group_rows(df: DataFrame, domain: str, metric: str, value: Column, key: str) -> DataFrame:
    """One row per group with `dims` = `key=<group>`; rows without a group are left out."""
    return df.filter(F.col(key).isNotNull()).select(
        F.lit(domain).alias("domain"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        F.concat(F.lit(f"{key}="), F.col(key).cast("string")).alias("dims"),
    )


# --- sales --------------------------------------------------------------------------


def monthly_sales(fact_orders: DataFrame) -> DataFrame:
    """Completed orders per month that has any; exact decimals."""
    return (
        completed_orders(fact_orders)
        .groupBy(F.trunc(F.to_date("timestamp"), "month").alias("month"))
        .agg(
            F.sum(money("amount")).alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("quantity").alias("units"),
            F.sum(money("margin_amount")).alias("margin"),
        )
    )


def monthly_growth(monthly: DataFrame) -> DataFrame:
    """Adds growth against the previous month present. One row per month, so the window
    without partitions sorts no more than the calendar holds."""
    before = F.lag(F.col("revenue").cast("double")).over(W.orderBy("month"))
    return monthly.withColumn("growth_pct", ratio(F.col("revenue").cast("double") - before, before) * 100)


def sales_kpis(fact_orders: DataFrame) -> DataFrame:
    months = monthly_growth(monthly_sales(fact_orders))
    totals = months.agg(
        or_zero(F.sum("revenue").cast("double")).alias("revenue"),
        or_zero(F.sum("orders").cast("double")).alias("orders"),
        or_zero(F.sum("units").cast("double")).alias("units"),
        or_zero(F.sum("margin").cast("double")).alias("margin"),
        F.max_by("growth_pct", "month").alias("growth"),
    )
    revenue, orders, margin = F.col("revenue"), F.col("orders"), F.col("margin")
    return metric_rows(
        totals.select(
            revenue.alias("total_revenue"),
            orders.alias("total_orders"),
            or_zero(ratio(revenue, orders)).alias("average_order_value"),
            F.col("units").alias("total_units_sold"),
            margin.alias("total_margin"),
            or_zero(ratio(margin, revenue) * 100).alias("margin_pct"),
            F.col("growth").alias("mom_revenue_growth_pct"),
        ),
        "sales",
    )


# --- customers ----------------------------------------------------------------------


def orders_per_customer(fact_orders: DataFrame) -> DataFrame:
    return (
        completed_orders(fact_orders)
        .filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def customer_kpis(fact_orders: DataFrame, dim_customer: DataFrame, recent_days: int = 30) -> DataFrame:
    per_customer = orders_per_customer(fact_orders)
    repeat = per_customer.agg(
        or_zero(ratio(F.count_if(F.col("orders") >= 2), F.count(F.lit(1))) * 100).alias("repeat_customer_rate_pct")
    )
    # one row per registration day: the latest day is found among days, not customers
    per_day = dim_customer.groupBy(F.to_date("registration_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    latest = F.max("day").over(W.partitionBy())
    registered = per_day.withColumn("recent", F.col("day") >= F.date_sub(latest, recent_days)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_customers"),
        F.coalesce(F.sum(F.when(F.col("recent"), F.col("n"))), F.lit(0)).alias(f"new_customers_last_{recent_days}d"),
    )
    segments = (
        per_customer.join(dim_customer.select("customer_key", "segment"), "customer_key")
        .groupBy("segment")
        .agg(F.sum("orders").alias("orders"))
    )
    return (
        metric_rows(registered, "customers")
        .unionByName(metric_rows(repeat, "customers"))
        .unionByName(group_rows(segments, "customers", "orders_by_segment", F.col("orders"), "segment"))
    )


# --- inventory ----------------------------------------------------------------------


def stock_and_sales_per_product(fact_inventory: DataFrame, fact_orders: DataFrame) -> DataFrame:
    stock = fact_inventory.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("items"),
        F.count("stock_position").alias("known"),
        F.sum("stock_position").alias("stock"),
        F.count_if(F.col("stock_position") <= 0).alias("at_risk"),
        F.count_if("below_reorder_level").alias("below"),
    )
    sold = completed_orders(fact_orders).groupBy("product_key").agg(F.sum("quantity").alias("units"))
    return stock.join(sold, "product_key", "left")


def inventory_kpis(fact_inventory: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Turnover is the mean over products of units sold / mean stock. It is averaged as a
    decimal with ten places, which keeps the mean independent of row order."""
    turnover = ratio(F.col("units"), ratio(F.col("stock"), F.col("known"))).cast("decimal(28,10)")
    totals = (
        stock_and_sales_per_product(fact_inventory, fact_orders)
        .withColumn("turnover", turnover)
        .agg(
            F.coalesce(F.sum("at_risk"), F.lit(0)).alias("at_risk"),
            F.coalesce(F.sum("below"), F.lit(0)).alias("below"),
            ratio(F.sum("stock"), F.sum("known")).alias("avg_stock"),
            or_zero(ratio(F.sum("turnover"), F.count("turnover"))).alias("turnover"),
        )
    )
    return metric_rows(
        totals.select(
            F.col("at_risk").alias("stockout_risk_item_count"),
            F.col("below").alias("items_below_reorder_level"),
            F.col("avg_stock").alias("avg_stock_position"),
            F.col("turnover").alias("inventory_turnover_ratio"),
            ratio(F.lit(365.0), F.col("turnover")).alias("days_of_inventory"),
        ),
        "inventory",
    )


# --- delivery -----------------------------------------------------------------------


def delivery_per_partner(fact_delivery: DataFrame) -> DataFrame:
    return fact_delivery.groupBy("partner").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.count_if("sla_breached").alias("breaches"),
        F.sum(money("delivery_hours")).alias("hours"),
        F.count("delivery_hours").alias("timed"),
    )


def delivery_kpis(fact_delivery: DataFrame) -> DataFrame:
    """Without deliveries the on-time share is 0 and the breach share 100."""
    partners = delivery_per_partner(fact_delivery)
    on_time = or_zero(ratio(F.sum("deliveries") - F.sum("breaches"), F.sum("deliveries")) * 100)
    overall = partners.agg(on_time.alias("on_time"), ratio(F.sum("hours"), F.sum("timed")).alias("hours")).select(
        F.col("on_time").alias("on_time_delivery_pct"),
        (F.lit(100.0) - F.col("on_time")).alias("sla_breach_pct"),
        F.col("hours").alias("avg_delivery_hours"),
    )
    breach_pct = ratio(F.col("breaches"), F.col("deliveries")) * 100
    return metric_rows(overall, "delivery").unionByName(
        group_rows(partners, "delivery", "partner_sla_breach_pct", breach_pct, "partner")
    )


# --- marketing ----------------------------------------------------------------------


def marketing_per_channel(fact_marketing: DataFrame) -> DataFrame:
    return fact_marketing.groupBy("channel").agg(
        F.sum(money("spend")).alias("spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
    )


def marketing_kpis(fact_marketing: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Return on ad spend takes the mean completed order as value of a conversion. Channel
    and month totals are stacked and summed together, which needs no join."""
    channels = marketing_per_channel(fact_marketing)
    sales = monthly_sales(fact_orders).select("revenue", "orders")
    stacked = channels.drop("channel").unionByName(sales, allowMissingColumns=True)
    total = stacked.agg(*[or_zero(F.sum(c).cast("double")).alias(c) for c in stacked.columns])
    order_value = or_zero(ratio(F.col("revenue"), F.col("orders")))
    overall = total.select(
        F.col("spend").alias("total_spend"),
        or_zero(ratio(F.col("clicks"), F.col("impressions")) * 100).alias("ctr_pct"),
        or_zero(ratio(F.col("conversions"), F.col("clicks")) * 100).alias("conversion_rate_pct"),
        ratio(F.col("spend"), F.col("conversions")).alias("cac"),
        ratio(F.col("conversions") * order_value, F.col("spend")).alias("estimated_roas"),
    )
    channel_cac = ratio(F.col("spend"), F.col("conversions"))
    return metric_rows(overall, "marketing").unionByName(
        group_rows(channels, "marketing", "channel_cac", channel_cac, "channel")
    )


# --- all domains --------------------------------------------------------------------


def kpi_snapshot(
    fact_orders: DataFrame,
    dim_customer: DataFrame,
    fact_inventory: DataFrame,
    fact_delivery: DataFrame,
    fact_marketing: DataFrame,
) -> DataFrame:
    """KPI rows of all domains, stamped with the time of the run."""
    parts = [
        sales_kpis(fact_orders),
        customer_kpis(fact_orders, dim_customer),
        inventory_kpis(fact_inventory, fact_orders),
        delivery_kpis(fact_delivery),
        marketing_kpis(fact_marketing, fact_orders),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("computed_at", F.current_timestamp())


def executive_summary(snapshot: DataFrame) -> DataFrame:
    """The headline metrics as one wide row."""
    return snapshot.groupBy().pivot("metric", SUMMARY_METRICS).agg(F.first("value"))
