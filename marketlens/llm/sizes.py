"""Broadcasts of measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import stored


def small_side(frame: DataFrame, most_rows: int, name: str = "side") -> DataFrame:
    """`frame` stored, and marked for broadcast if it has at most `most_rows` rows.

    Beyond that the join it is used in shuffles both sides; the rows are the same.
    """
    kept = stored(frame, name)
    return F.broadcast(kept) if kept.limit(most_rows + 1).count() <= most_rows else kept
