"""Joins of a large table with a table that is unique on the join key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import stored


def input_bytes(df: DataFrame) -> int:
    """Size of all files `df` is computed from, as known to the optimizer. No job is run."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def lookup(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Joins `fact` with `dim`, which must be unique on `on`.

    No side is forced: adaptive execution broadcasts `dim` when its measured size is below
    the session's threshold. Else both sides are shuffled, and a hot key of `fact` makes one
    large partition, which is split (skew join), since `dim` has one row per key.
    """
    return fact.join(dim, on, how)


def small_side(dim: DataFrame, most_rows: int, name: str) -> DataFrame:
    """`dim` stored, and marked for broadcast if it has at most `most_rows` rows; beyond that
    a join with it shuffles both sides. Runs a job."""
    kept = stored(dim, name)
    return F.broadcast(kept) if kept.limit(most_rows + 1).count() <= most_rows else kept


def one_per_key(dim: DataFrame, on: str) -> DataFrame:
    """`dim`, which is unique on `on`, in a form that tells the optimizer so: a left join with
    it is dropped where none of its columns is read. Null keys, which match nothing, are one."""
    others = [F.first(c).alias(c) for c in dim.columns if c != on]
    return dim.groupBy(on).agg(*others) if others else dim.distinct()
