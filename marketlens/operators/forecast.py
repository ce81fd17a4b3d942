"""Seven-day revenue forecast: linear trend plus weekday level, least squares.

Regressing revenue on time and weekday dummies splits into a common slope within
weekdays and one level per weekday (Frisch-Waugh-Lovell). Both need only sums per
weekday, so one aggregate per series fits any number of series at once. Sums are
integers and decimals; the result does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.functions.columns import money, round_even

MODEL_NAME = "linear_trend_plus_dow_seasonality"
BAND_SIGMAS = 1.28  # fixed value: half width of the 80% band
WEEKDAYS = range(7)


def time_index(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Position of each day within its series, counting days present from zero."""
    t = F.row_number().over(W.partitionBy(*by).orderBy("day")) - 1
    return daily.withColumns({"t": t.cast("bigint"), "dow": F.weekday("day"), "y": money("revenue")})


def _centred(cross: str, left: str, right: str) -> str:
    """Sum over weekdays of the products of deviations from the weekday means, each exact
    up to one division: (n * sum of products - product of sums) / n."""
    return " + ".join(
        f"coalesce(try_divide(cast({cross}{d} * n{d} - {left}{d} * {right}{d} as double), n{d}), 0D)" for d in WEEKDAYS
    )


def _weekday_sums(d: int) -> list[str]:
    """Sums of one weekday: count, t, t*t, revenue, t*revenue, revenue*revenue."""
    here = f"filter (where dow = {d})"
    return [
        f"count(1) {here} as n{d}",
        f"cast(sum(t) {here} as decimal(18,0)) as t{d}",
        f"cast(sum(t * t) {here} as decimal(18,0)) as tt{d}",
        f"cast(sum(y) {here} as decimal(20,2)) as y{d}",
        f"cast(sum(cast(t as decimal(10,0)) * y) {here} as decimal(28,2)) as ty{d}",
        f"sum(cast(y * y as decimal(38,4))) {here} as yy{d}",
    ]


def fit(daily: DataFrame, by: Sequence[str] = (), min_days: int = 14) -> DataFrame:
    """One model row per series with at least `min_days` days: slope, level per weekday,
    residual standard deviation (population), last day and last index."""
    sums = [F.expr(e) for d in WEEKDAYS for e in _weekday_sums(d)]
    shape = [F.expr(e) for e in ("count(1) as days", "max(day) as last_day", "max(t) as last_t")]
    stats = time_index(daily, by).groupBy(*by).agg(*shape, *sums).filter(F.col("days") >= min_days)
    kept = [*by, "days", "last_day", "last_t"]
    solved = stats.selectExpr(
        "*",
        f"{_centred('tt', 't', 't')} as sxx",
        f"{_centred('ty', 't', 'y')} as sxy",
        f"{_centred('yy', 'y', 'y')} as syy",
    ).selectExpr("*", "try_divide(sxy, sxx) as slope")
    levels = ", ".join(
        f"try_divide(cast(y{d} as double), n{d}) - slope * try_divide(cast(t{d} as double), n{d})" for d in WEEKDAYS
    )
    return solved.selectExpr(
        *kept,
        "slope",
        "sqrt(greatest(syy - slope * sxy, 0D) / days) as resid_std",
        f"array({levels}) as levels",
    )


def project(model: DataFrame, by: Sequence[str] = (), horizon: int = 7) -> DataFrame:
    """The next `horizon` days with an 80% band; values are clamped at zero.

    A weekday never seen takes the level of the smallest weekday seen, which is the
    reference level of the regression.
    """
    base_level = F.element_at(F.array_compact("levels"), 1)
    steps = model.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")).withColumn(
        "forecast_day", F.date_add("last_day", F.col("h"))
    )
    level = F.coalesce(F.get("levels", F.weekday("forecast_day")), base_level)
    point = F.greatest(level + F.col("slope") * (F.col("last_t") + F.col("h")), F.lit(0.0))
    half = F.lit(BAND_SIGMAS) * F.col("resid_std")
    return steps.withColumn("_point", point).select(
        *by,
        "forecast_day",
        round_even(F.col("_point"), 2).alias("predicted_revenue"),
        round_even(F.greatest(F.col("_point") - half, F.lit(0.0)), 2).alias("lower_bound_80pct"),
        round_even(F.col("_point") + half, 2).alias("upper_bound_80pct"),
    )


def revenue_forecast(
    daily: DataFrame, by: Sequence[str] = (), horizon: int = 7, min_days: int = 14
) -> DataFrame:
    """Forecast rows per series; a series shorter than `min_days` gets none."""
    return project(fit(daily, by, min_days), by, horizon)


def stamped(forecast: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Adds the time of the run, now unless given, and the model name for the stored table."""
    made = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    return forecast.withColumns({"generated_at": made, "model": F.lit(MODEL_NAME)})
