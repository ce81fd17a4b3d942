"""One row per key, decided by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COPIES = "copies"
_PLACE = "_place"


def keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], largest: bool = True, unique: bool = False
) -> DataFrame:
    """Keeps the row of each key that is largest (or smallest) by `order`.

    Ties are settled by all remaining columns ascending, unless `order` is known to be
    `unique`, so that other columns need not be read; nulls come last throughout, so the
    result does not depend on partitioning. The filter on the first place lets
    Spark cut each key to one row per map task before the shuffle (window group limit):
    a key with a third of all rows moves no more data than any other. Name the most
    selective key first, it leads the sort.
    """
    rest = [] if unique else [c for c in df.columns if c not in keys and c not in order]
    lead = [F.col(c).desc_nulls_last() if largest else F.col(c).asc_nulls_last() for c in order]
    ranked = W.partitionBy(*keys).orderBy(*lead, *[F.col(c).asc_nulls_last() for c in rest])
    return df.withColumn(_PLACE, F.row_number().over(ranked)).filter(F.col(_PLACE) == 1).drop(_PLACE)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES)).filter(F.col(COPIES) > 1)
