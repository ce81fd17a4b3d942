"""Rows in the order of their ids, over many partitions, each a range of ids."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_bounds(docs: DataFrame, id_col: str, text_col: str, range_bytes: int) -> list[int]:
    """Ids that cut `docs` into ranges of about `range_bytes` of text; one number per range
    comes to the driver."""
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text_col).alias("size"))
    volume = known.agg(F.sum("size")).first()[0] or 0
    count = math.ceil(volume / range_bytes)
    if count < 2:
        return []
    cuts = known.where("id is not null").approxQuantile("id", [i / count for i in range(1, count)], 0.1 / count)
    return sorted({int(c) for c in cuts})


def range_of(ids: pa.Array, bounds: list[int]) -> np.ndarray:
    """The number of the range an id falls into, ascending; null ids are in the last."""
    values = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    return np.searchsorted(np.array(bounds, dtype=np.int64), values, side="right")


def running_start(parts: DataFrame, group: str, order: str, count: str) -> DataFrame:
    """`parts` with `before`: the sum of `count` over all earlier rows by group, then order.
    Groups are summed first, so that only one row per group goes through one task."""
    earlier = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    groups = parts.groupBy(group).agg(F.sum(count).alias("_held"))
    groups = groups.select(group, F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_earlier"))
    placed = parts.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0))).join(groups, group)
    return placed.withColumn("before", (F.col("_earlier") + F.col("_inside")).cast("long")).drop("_earlier", "_inside")
