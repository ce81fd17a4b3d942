"""Alert rules, alert numbering, the notification outbox and alert status."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.functions.columns import decimal_text, percent_true, ratio
from marketlens.operators.kpis import completed_orders
from marketlens.session import stored

# Rule names, severities, statuses and default thresholds.
STOCKOUT = "inventory_stockout_risk"
SLA_BREACH = "delivery_sla_breach"
REVENUE = "revenue_anomaly"
PAYMENTS = "payment_failure_rate"
RULES = [STOCKOUT, SLA_BREACH, REVENUE, PAYMENTS]
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
NOTIFIED_SEVERITIES = ["HIGH", "CRITICAL"]
STATUSES = ["OPEN", "ACKNOWLEDGED", "RESOLVED"]
SLA_BREACH_THRESHOLD_PCT = 15.0
REVENUE_SHORTFALL_THRESHOLD_PCT = 20.0
PAYMENT_FAILURE_THRESHOLD_PCT = 5.0
DEMAND_DAYS = 7
COVER_DAYS = 3.0

# Message formats.
STOCKOUT_TEXT = (
    "Product %s at warehouse %s is below reorder level (%s units) with ~%s units/day demand "
    "(~%s days of cover left)."
)
SLA_TEXT = "Overall delivery SLA breach rate is %s%%, above the %.0f%% threshold. Operations team notified."
REVENUE_TEXT = "Revenue on %s was %s, %s%% below the forecast of %s."
PAYMENTS_TEXT = (
    "Payment failure rate is %s%% (%d/%d payments), above the %.0f%% threshold. "
    "Payments/engineering team notified."
)

_NUMBERING_BUCKETS = 1024


def _alert(rule: str, severity: str, entity: Column, message: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        F.lit("OPEN").alias("status"),
        entity.alias("entity"),
        message.alias("message"),
    ]


# --- rules --------------------------------------------------------------------------


def recent_demand(fact_orders: DataFrame, days: int = DEMAND_DAYS) -> DataFrame:
    """Mean units per day and product over the last `days` days of the data.

    The cut is a scalar subquery over one column, so it reaches the scan as a filter.
    """
    completed = completed_orders(fact_orders)
    since = completed.agg(F.max("timestamp") - F.make_dt_interval(days=F.lit(days))).scalar()
    return (
        completed.filter(F.col("timestamp") >= since)
        .groupBy("product_key")
        .agg((F.sum("quantity") / F.lit(float(days))).alias("avg_daily_demand"))
    )


def stockout_alerts(
    fact_inventory: DataFrame, fact_orders: DataFrame, days: int = DEMAND_DAYS, cover_days: float = COVER_DAYS
) -> DataFrame:
    """Items below reorder level that recent demand empties within `cover_days`."""
    demand = recent_demand(fact_orders, days).filter(F.col("avg_daily_demand") > 0)
    stock, rate = F.col("stock_position"), F.col("avg_daily_demand")
    message = F.format_string(
        STOCKOUT_TEXT,
        F.col("product_key").cast("string"),
        F.col("warehouse_key").cast("string"),
        stock.cast("string"),
        decimal_text("avg_daily_demand"),
        decimal_text("days_of_cover"),
    )
    entity = F.concat_ws(":", F.col("warehouse_key").cast("string"), F.col("product_key").cast("string"))
    return (
        fact_inventory.filter("below_reorder_level")
        .join(demand, "product_key")
        .withColumn("days_of_cover", ratio(stock, rate))
        .filter(F.col("days_of_cover") < cover_days)
        .select(*_alert(STOCKOUT, "HIGH", entity, message))
    )


def sla_alerts(fact_delivery: DataFrame, threshold: float = SLA_BREACH_THRESHOLD_PCT) -> DataFrame:
    """One alert when the overall share of late deliveries exceeds `threshold` percent."""
    message = F.format_string(
        SLA_TEXT,
        decimal_text("breach_pct"),
        F.lit(float(threshold)),
    )
    return (
        fact_delivery.agg(percent_true(F.col("sla_breached")).alias("breach_pct"))
        .filter(F.col("breach_pct") > threshold)
        .select(*_alert(SLA_BREACH, "HIGH", F.lit("delivery_network"), message))
    )


def revenue_alerts(
    daily: DataFrame, forecast: DataFrame, threshold: float = REVENUE_SHORTFALL_THRESHOLD_PCT
) -> DataFrame:
    """One alert when the last actual day fell short of its forecast by more than
    `threshold` percent. A forecast made from all actuals starts one day later and
    never matches; pass one made earlier."""
    last = daily.agg(F.max_by(F.struct("day", "revenue"), "day").alias("last")).select("last.*")
    expected = F.col("predicted_revenue")
    message = F.format_string(
        REVENUE_TEXT,
        F.col("day").cast("string"),
        F.format_number("revenue", 0),
        decimal_text("shortfall_pct"),
        F.format_number(expected, 0),
    )
    return (
        last.join(forecast, F.col("day") == F.col("forecast_day"))
        .withColumn("shortfall_pct", ratio(expected - F.col("revenue"), expected) * 100)
        .filter((expected > 0) & (F.col("shortfall_pct") > threshold))
        .select(*_alert(REVENUE, "CRITICAL", F.col("day").cast("string"), message))
    )


def payment_alerts(live_metrics: DataFrame, threshold: float = PAYMENT_FAILURE_THRESHOLD_PCT) -> DataFrame:
    """One alert when failed payments exceed `threshold` percent of all payments."""
    total = _metric("live_payments_total")
    failures = F.coalesce(_metric("live_payment_failures_total"), F.lit(0.0))
    message = F.format_string(
        PAYMENTS_TEXT,
        decimal_text("failure_pct"),
        F.col("failures").cast("bigint"),
        F.col("total").cast("bigint"),
        F.lit(float(threshold)),
    )
    return (
        live_metrics.agg(total.alias("total"), failures.alias("failures"))
        .withColumn("failure_pct", ratio(F.col("failures"), F.col("total")) * 100)
        .filter(F.col("failure_pct") > threshold)
        .select(*_alert(PAYMENTS, "HIGH", F.lit("payments_platform"), message))
    )


def _metric(key: str) -> Column:
    return F.max(F.when(F.col("metric_key") == key, F.col("metric_value").cast("double")))


def all_alerts(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- storing ------------------------------------------------------------------------


def numbered(alerts: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Adds `alert_id` = ALRT-<running number>-<run epoch>, `created_at` and `notified`.

    The running number is dense without sorting all alerts in one task: rows are
    numbered inside hash buckets and shifted by the counts of the buckets before,
    a table of fixed size. Runs a job: the alerts are stored once, since they are read
    for the counts and for the rows.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    bucket = F.pmod(F.xxhash64("rule", "entity", "message"), F.lit(_NUMBERING_BUCKETS))
    placed = stored(alerts.withColumn("_bucket", bucket), "alerts")
    before = F.sum("n").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy("rule", "entity", "message"))
    number = F.col("_offset") + inside
    digits = F.lpad(number.cast("string"), F.greatest(F.lit(5), F.length(number.cast("string"))), F.lit("0"))
    return placed.join(F.broadcast(offsets), "_bucket").select(
        F.concat(F.lit("ALRT-"), digits, F.lit(f"-{int(run_ts.timestamp())}")).alias("alert_id"),
        *alerts.columns,
        F.lit(run_ts).alias("created_at"),
        F.col("severity").isin(NOTIFIED_SEVERITIES).alias("notified"),
    )


def outbox(alerts: DataFrame, sender: str = "Retail operations") -> DataFrame:
    """Messages to be delivered: HIGH and CRITICAL alerts with a subject line."""
    subject = F.concat(F.lit(f"[{sender}] "), F.col("severity"), F.lit(" alert: "), F.col("rule"))
    return alerts.filter(F.col("severity").isin(NOTIFIED_SEVERITIES)).select(
        *[c for c in ("alert_id",) if c in alerts.columns], "rule", "entity", subject.alias("subject"), "message"
    )


# --- status -------------------------------------------------------------------------


def split_status_events(events: DataFrame, alerts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Status changes that are valid, and those refused for an unknown status or alert."""
    known = alerts.select("alert_id").distinct().withColumn("_known", F.lit(True))
    marked = events.join(known, "alert_id", "left").withColumn(
        "refused_because",
        F.when(~F.col("status").isin(STATUSES) | F.col("status").isNull(), F.lit("invalid status")).when(
            F.col("_known").isNull(), F.lit("alert not found")
        ),
    )
    valid = marked.filter(F.col("refused_because").isNull()).select(*events.columns)
    return valid, marked.filter(F.col("refused_because").isNotNull()).drop("_known")


def current_status(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts with the status of their latest valid change; without one they keep theirs.

    Changes are reduced to one per alert before the join, so an alert that is changed
    over and over stays cheap; changes of unknown alerts find no partner."""
    latest = (
        events.filter(F.col("status").isin(STATUSES))
        .groupBy("alert_id")
        .agg(F.max(F.struct("changed_at", "status")).alias("_last"))
    )
    return (
        alerts.join(latest, "alert_id", "left")
        .withColumn("status", F.coalesce(F.col("_last.status"), F.col("status")))
        .select(*alerts.columns)
    )
