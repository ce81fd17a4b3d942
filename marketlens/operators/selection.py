"""Exact quantiles of many or few series without sorting a series in one task.

A histogram between the least and the greatest value says which bin holds the wanted rank;
the next one looks only between the least and the greatest value of that bin. After a few
rounds the values left are counted, each distinct one once. Every round sends at most `bins`
rows per series and map task, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_quantile(
    rows: DataFrame, value: str, share: float, by: Sequence[str], bins: int = 1024, rounds: int = 2
) -> DataFrame:
    """One row per series: `by`, `n` (values that are not null) and `quantile`.

    The value at rank `(n - 1) * share` of the ascending values, counted from zero; between
    two ranks it is interpolated linearly. Binning only has to keep the order of values, so
    rounding in it does no harm. Nothing runs until the result is used; `rows` is read
    `rounds` + 2 times, so store it where it is dear. Values far from each other (one
    outlier that stretches the range) are parted by more `rounds`.
    """
    known = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    spans = known.groupBy(*by).agg(F.count("_v").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    rank = f"((n - 1) * {float(share)!r}D)"
    sides = f"array(struct(0 as _side, floor({rank}) as _place), struct(1 as _side, ceil({rank}) as _place))"
    wanted = spans.select(*by, "n", "_lo", "_hi", F.expr(f"inline({sides})"))
    groups = [*by, "_side"]
    for _ in range(rounds):
        inside = known.join(wanted.drop("n"), list(by)).where("_v between _lo and _hi")
        # the share of the way from the least to the greatest, null or NaN where they agree
        step = f"nanvl(floor(try_divide(_v - _lo, _hi - _lo) * {bins}), 0D)"
        binned = inside.withColumn("_bin", F.expr(f"least(coalesce({step}, 0D), {bins - 1})"))
        counts = binned.groupBy(*groups, "_bin").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        )
        found = _holding(counts, "_bin", wanted.select(*groups, "n", "_place"), by)
        wanted = found.select(*groups, "n", F.col("_low").alias("_lo"), F.col("_high").alias("_hi"), "_place")
    inside = known.join(wanted.drop("n"), list(by)).where("_v between _lo and _hi")
    counts = inside.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n"))
    chosen = _holding(counts, "_v", wanted.select(*groups, "n", "_place"), by)
    ends = chosen.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.max(F.expr("if(_side = 0, _v, null)")).alias("_lo"),
        F.max(F.expr("if(_side = 1, _v, null)")).alias("_hi"),
    )
    return ends.select(*by, "n", F.expr(f"_lo + (_hi - _lo) * ({rank} - floor({rank}))").alias("quantile"))


def _holding(counts: DataFrame, order: str, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each series and side the row of `counts` that holds the wanted place, which becomes
    the place within that row."""
    upto = W.partitionBy(*by, "_side").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
    held = summed.join(wanted, [*by, "_side"]).where("_place >= _before and _place < _before + _n")
    return held.withColumn("_place", F.col("_place") - F.col("_before"))
