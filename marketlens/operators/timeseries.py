"""Daily panel, rolling z-score, anomaly explanation.

A panel has one row per day that has revenue (optionally per day and series, e.g.
per warehouse, through `by`). All windows run on the panel, never on facts: they
are partitioned by the series, and a single series is as long as its calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.functions.columns import decimal_text, is_true, money, money_sum, or_zero, ratio
from marketlens.operators.isolation import CONTAMINATION, isolation_forest
from marketlens.operators.kpis import completed_orders

# Panel columns with their names in explanation texts.
DRIVERS = {
    "revenue": "revenue",
    "orders": "order volume",
    "aov": "average order value",
    "sla_breach_rate": "SLA breach rate",
}
SLA_DRIVER = "sla_breach_rate"

# Texts of explanations and recommended actions.
NO_HISTORY = "Insufficient history to compute baseline."
NO_DRIVER = "no single dimension moved sharply; likely broad-based fluctuation"
ACTION_SLA = (
    "Investigate delivery partner performance on this date and escalate to operations; "
    "SLA breaches likely suppressed repeat purchases/completions."
)
ACTION_DROP = (
    "Escalate to the business-anomaly alert queue and cross-check for marketing spend pauses, "
    "payment gateway issues, or inventory stockouts on the affected date."
)
ACTION_POSITIVE = (
    "Positive anomaly — flag to marketing/growth to identify and replicate the driver "
    "(e.g. a successful campaign or promo)."
)


def daily_revenue(fact_orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        completed_orders(fact_orders)
        .groupBy(*by, F.to_date("timestamp").alias("day"))
        .agg(money_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


def daily_panel(fact_orders: DataFrame, fact_delivery: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue, orders, mean order value and breach share (by pickup day) per day with revenue."""
    breaches = (
        fact_delivery.groupBy(*by, F.to_date("pickup_time").alias("day"))
        .agg(ratio(F.count_if("sla_breached"), F.count(F.lit(1))).alias("sla_breach_rate"))
    )
    return (
        daily_revenue(fact_orders, by)
        .join(breaches, [*by, "day"], "left")
        .select(
            *by,
            "day",
            "revenue",
            "orders",
            or_zero(F.col("sla_breach_rate")).alias("sla_breach_rate"),
            ratio(F.col("revenue"), F.col("orders")).alias("aov"),
        )
    )


def _in_day_order(by: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*by).orderBy("day")


def rolling_zscore(
    panel: DataFrame,
    window: int = 7,
    threshold: float = 2.5,
    min_rows: int = 3,
    include_current: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Flags days whose revenue is far from the mean of the last `window` rows.

    With the current row inside the frame |z| cannot exceed (window-1)/sqrt(window),
    2.27 for seven rows, so the default threshold never fires; lower it or take the
    frame before the current row with `include_current=False`. Sums are decimal, so a
    constant series has a spread of exactly zero and no z-score.
    """
    frame = _in_day_order(by).rowsBetween(-(window - 1), 0) if include_current else _in_day_order(by).rowsBetween(
        -window, -1
    )
    amount = money("revenue")
    n = F.count("revenue").over(frame)
    total = F.sum(amount).over(frame).cast("decimal(18,2)")
    squares = F.sum((amount * amount).cast("decimal(38,4)")).over(frame)
    spread = ratio(squares * n - (total * total).cast("decimal(38,4)"), n * (n - 1))
    scored = panel.withColumns({"_n": n, "_mean": ratio(total, n), "_std": F.sqrt(F.nullif(spread, F.lit(0.0)))})
    z = F.when(F.col("_n") >= min_rows, ratio(F.col("revenue") - F.col("_mean"), F.col("_std")))
    return (
        scored.withColumn("revenue_zscore", z)
        .withColumn("is_anomaly_statistical", is_true(F.abs("revenue_zscore") > threshold))
        .drop("_n", "_mean", "_std")
    )


def explain_days(panel: DataFrame, window: int = 7, min_change_pct: float = 15.0, by: Sequence[str] = ()) -> DataFrame:
    """Adds the prior-rows baseline, the drivers of each day and a recommended action.

    A driver is a column that moved by more than `min_change_pct` against the mean of
    the previous `window` rows; the three largest are named. A first day has no baseline.
    """
    prior = _in_day_order(by).rowsBetween(-window, -1)
    base = {
        c: (
            ratio(F.sum(money(c)).over(prior), F.count(c).over(prior))
            if c == "revenue"
            else F.avg(F.col(c).cast("double")).over(prior)
        )
        for c in DRIVERS
    }
    with_base = panel.withColumns({f"_base_{c}": column for c, column in base.items()}).withColumn(
        "_history", F.count(F.lit(1)).over(prior)
    )
    with_change = with_base.withColumns({f"_pct_{c}": _change_pct(c) for c in DRIVERS})
    sharp = {c: is_true(F.abs(f"_pct_{c}") > min_change_pct) for c in DRIVERS}
    found = F.array_compact(
        F.array(*[F.when(sharp[c], _driver(f"_pct_{c}", label, window)) for c, label in DRIVERS.items()])
    )
    ranked = F.transform(F.slice(F.sort_array(found, asc=False), 1, 3), lambda d: d["text"])
    text = F.when(F.size(ranked) > 0, F.array_join(ranked, "; ")).otherwise(F.lit(NO_DRIVER))
    fell = is_true(F.col("revenue") < F.col("_base_revenue"))
    action = (
        F.when(F.col("_history") == 0, F.lit(""))
        .when(fell & sharp[SLA_DRIVER], F.lit(ACTION_SLA))
        .when(fell, F.lit(ACTION_DROP))
        .otherwise(F.lit(ACTION_POSITIVE))
    )
    return with_change.withColumns(
        {
            "baseline_avg_revenue": F.col("_base_revenue"),
            "explanation": F.when(F.col("_history") == 0, F.lit(NO_HISTORY)).otherwise(text),
            "recommended_action": action,
        }
    ).select(*panel.columns, "baseline_avg_revenue", "explanation", "recommended_action")


def anomaly_report(panel: DataFrame, threshold: float = 2.5, contamination: float = CONTAMINATION) -> DataFrame:
    """Panel with both detectors and a flag set by either. Runs jobs, see `isolation_forest`."""
    by_forest = isolation_forest(panel, contamination)
    both = rolling_zscore(by_forest, threshold=threshold)
    return both.withColumn("is_anomaly", F.col("is_anomaly_statistical") | F.col("is_anomaly_iforest"))


def _change_pct(column: str) -> Column:
    base = F.col(f"_base_{column}")
    return ratio(F.col(column).cast("double") - base, F.abs(base)) * 100


def _driver(change: str, label: str, window: int) -> Column:
    text = F.concat(
        F.expr(f"'{label} was ' || if({change} > 0, 'up ', 'down ')"),
        decimal_text(f"abs({change})"),
        F.lit(f"% vs. the trailing {window}-day average"),
    )
    return F.struct(F.abs(change).alias("size"), text.alias("text"))


def pick_explanations(report: DataFrame, most: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Of the flagged days the most severe one, then others in day order, `most` in all."""
    severity = F.abs("revenue_zscore").desc_nulls_last()
    flagged = report.filter("is_anomaly")
    worst = F.row_number().over(W.partitionBy(*by).orderBy(severity, "day")) == 1
    place = F.row_number().over(W.partitionBy(*by).orderBy(F.col("_worst").desc(), "day"))
    return (
        flagged.withColumn("_worst", worst)
        .withColumn("place", place)
        .filter(F.col("place") <= most)
        .select(*by, "place", "day", "revenue", "baseline_avg_revenue", "explanation", "recommended_action")
    )
